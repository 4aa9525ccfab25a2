"""Passages of a document that share the most weighted words with a criterion.

A passage is a run of one to three neighbouring lines. A document and its criteria meet once, in one row;
all else (weights, runs, the greedy choice of runs without common lines) is done there, so nothing but
the texts is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import words

SPAN = 3


def _half_up(x: float, digits: int) -> float:
    """As Spark's round: halves of the number as it is printed go up."""
    scaled = x * 10**digits
    if abs(scaled - math.floor(scaled) - 0.5) > 1e-6:
        return math.floor(scaled + 0.5) / 10**digits
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def _chosen(lines: list[set[str]], idf: dict[str, float], asked: set[str], top: int) -> list[tuple[int, int, float]]:
    """(first row, rows, score) of the chosen runs."""
    total, hit, runs = math.fsum(idf.get(t, math.log(len(lines) + 1) + 1) for t in asked), [not own.isdisjoint(asked) for own in lines], []
    for start in range(len(lines)):
        own: set[str] = set()
        for n in range(1, min(SPAN, len(lines) - start) + 1):
            own = own | lines[start + n - 1]
            if any(hit[start : start + n]):
                found = math.fsum(idf[t] for t in own & asked)
                runs.append((-_half_up(found / total, 2), n, -_half_up(found / math.fsum(idf[t] for t in own), 3), start))
    used, out = set(), []
    for score, n, _, start in sorted(runs):
        if used.isdisjoint(range(start, start + n)):
            used.update(range(start, start + n))
            out.append((start, n, -score))
        if len(out) == top:
            break
    return out


def best_passages(docs: DataFrame, criteria: DataFrame, doc_id: str, text: str, criterion_id: str, criterion: str, top: int = 3) -> DataFrame:
    """``doc_id``, ``criterion_id``, ``place``, ``first_line``, ``n_lines``, ``score``: up to ``top`` passages by rounded score, then fewer lines, then precision, then position.

    Weights are ln((n + 1) / (df + 1)) + 1 over the document's nonblank lines. Both tables carry
    ``doc_id``: a criterion is looked for in its own document.
    """
    line = lambda raw, i: F.struct(i.cast("int").alias("line"), raw.alias("raw"))
    texts = docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.collect_list(F.col(text)).alias("texts"))
    lines = F.flatten(F.transform("texts", lambda t: F.transform(F.split(t, "\n"), line)))
    lines = F.filter(F.when(F.size("texts") > 1, F.array_sort(lines)).otherwise(lines), lambda x: F.trim(x["raw"]) != "")
    terms = F.transform(lines, lambda x: F.struct(x["line"].alias("line"), F.array_distinct(words(x["raw"])).alias("terms")))
    asked = criteria.groupBy(doc_id).agg(F.collect_list(F.struct(F.col(criterion_id).alias("id"), words(F.col(criterion)).alias("terms"))).alias("asked"))
    met = texts.join(asked, doc_id).select(doc_id, terms.alias("lines"), "asked")

    def run(batches):
        for batch in batches:
            ids, at, found = batch.column(2).flatten().field(0), 0, []
            for i in range(batch.num_rows):
                rows, own = batch.column(1)[i].as_py(), batch.column(2)[i].values
                lines = [set(r["terms"]) for r in rows]
                df = Counter(t for x in lines for t in x)
                idf = {t: math.log((len(lines) + 1) / (n + 1)) + 1 for t, n in df.items()}
                wanted: dict = {}
                for j, r in enumerate(own.to_pylist()):
                    wanted.setdefault(r["id"], (at + j, set()))[1].update(r["terms"])
                at += len(own)
                for place_of, terms in wanted.values():
                    found += [(i, place_of, place, rows[start]["line"], n, score) for place, (start, n, score) in enumerate(_chosen(lines, idf, terms, top), 1)]
            doc, item, place, first, n, score = zip(*found, strict=True) if found else ([],) * 6
            numbers = [pa.array(x, pa.int32()) for x in (place, first, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), ids.take(pa.array(item, pa.int64())), *numbers, pa.array(score, pa.float64())], ["d", "c", "place", "first_line", "n_lines", "score"])

    kinds = dict(docs.dtypes)[doc_id], dict(criteria.dtypes)[criterion_id]
    return met.mapInArrow(run, f"d {kinds[0]}, c {kinds[1]}, place int, first_line int, n_lines int, score double").toDF(doc_id, criterion_id, "place", "first_line", "n_lines", "score")
