"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Fitting: a bounded sample of labelled rows gives the examples: the ``sample_rows`` smallest hashes of the
id, and of these, in that order, as many as have ``sample_bytes`` of text. All their terms are the
vocabulary; none is chosen, dropped or capped. Document frequencies are counted over the whole corpus.
A term's weight in a text is (1 + ln tf) * idf * (1 + s**2), s being the logarithm of the term's odds of a
toxic example over those of all examples, after ``PRIOR_ROWS`` more rows at the base rate: at any base
rate, and for any number of labels, a term that tells nothing keeps its plain TF-IDF weight. Plain
weights alone don't find toxic texts, as a few words decide (README has figures). The norm is taken over
all terms of a text; one that no example has weighs like a neutral term of a single document.

Index: examples with equal vectors are one entry with its counts of labels. Entries with the same
heaviest term lie together in blocks of ``BLOCK``; for each term and block in which it occurs, the
greatest weight and the place of its postings are kept. Terms of a tenth of the entries or more have a
full row each instead; a product of matrices adds those up for many queries at once. A block's bound
is the greatest such sum in it plus the greatest weights of all other terms. A query scores the blocks
of the highest bounds, and then reads postings of no other block but those whose bound reaches the
``k``-th best cosine found.

Scoring: the ``k`` nearest entries vote for their label, weighted by cosine / (distance + ``SOFT``), so
that a far neighbour alone decides nothing against the base rate. A monotone curve fitted to the
examples' own votes (each left out of its own) makes that a probability. Neighbours are returned as
evidence. What is broadcast and what comes to the driver is bounded by the sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType
from xxhash import xxh3_128_digest

from .blocks import bounded_batches, cut_rows, release_memory
from .storage import written
from .wordspans import folded_bytes, utf8, word_hashes

SAMPLE_ROWS, SAMPLE_BYTES, PRIOR_ROWS, NEIGHBOURS = 5_000, 32 << 20, 2.0, 25
BLOCK, COMMON, SOFT, PRIOR, DIGITS = 64, 10, 0.05, 1.0, 9
_PART_BYTES, _MEMO, _TOGETHER, _SIEVE_BITS = 1 << 20, 2_000, 64, 22


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the distinct terms of each text, in order. Words lose case and ASCII punctuation."""
    term, rows = word_hashes(*utf8(column), folded_bytes())
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if not len(row):
        return row, term, row
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    at = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])]))
    return row[at], term[at], np.diff(np.append(at, len(row)))


@dataclass
class Vocabulary:
    """The terms (sorted hashes), their weights, and the weight of any other term."""

    terms: np.ndarray
    weight: np.ndarray
    other: float = 0.0
    sieve: np.ndarray = field(init=False)

    def __post_init__(self):
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self._high(self.terms)] = True

    @staticmethod
    def _high(term: np.ndarray) -> np.ndarray:
        return (term >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)

    def places(self, term: np.ndarray) -> np.ndarray:
        """The position of each term, -1 for other ones."""
        out = np.full(len(term), -1, np.int64)
        near = np.flatnonzero(self.sieve[self._high(term)])
        at = np.searchsorted(self.terms, term[near])
        own = at < len(self.terms)
        own[own] = self.terms[at[own]] == term[near[own]]
        out[near[own]] = at[own]
        return out

    def vectors(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """(positions, weights) of each text's known terms; the vector of all its terms has length one."""
        row, term, n = terms_of(column)
        at = self.places(term)
        weight = (1 + np.log(n)) * np.where(at >= 0, self.weight[at] if len(self.weight) else 0.0, self.other)
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(column)))
        known = np.flatnonzero((at >= 0) & (weight > 0))
        row, at, weight = row[known], at[known], weight[known] / norm[row[known]]
        cuts = np.searchsorted(row, np.arange(len(column) + 1))
        return [(at[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers from each ``low`` on, ``size`` of them."""
    before = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(low - before[:-1], size) + np.arange(int(before[-1]))


class Examples:
    """Distinct labelled vectors in a block-max inverted index."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], ids: list[int], n_terms: int, k: int = NEIGHBOURS):
        self.k = k
        entries: dict[bytes, list] = {}
        keys = [at.tobytes() + weight.tobytes() for at, weight in vectors]
        for key, (at, weight), label, doc in zip(keys, vectors, labels, ids, strict=True):
            e = entries.setdefault(key, [at, weight, 0, 0, doc])
            e[2], e[3], e[4] = e[2] + 1, e[3] + label, min(e[4], doc)
        self.blank = tuple(entries.pop(b"", [None, None, 0, 0, None])[2:])
        # entries with the same heaviest term lie together, which keeps the blocks' bounds tight
        listed = sorted(entries, key=lambda x: (int(entries[x][0][np.argmax(entries[x][1])]), entries[x][4], x))
        place = {key: i for i, key in enumerate(listed)}
        self.of = np.array([place.get(key, -1) for key in keys], np.int64)  # the entry of each example; -1: no terms
        listed = [entries[key] for key in listed]
        self.n, self.toxic, self.doc = (np.array([e[i] for e in listed], np.int64) for i in (2, 3, 4))
        entry = np.repeat(np.arange(len(listed)), np.array([len(e[0]) for e in listed], np.int64))
        term = np.concatenate([e[0] for e in listed]) if listed else np.zeros(0, np.int64)
        weight = np.concatenate([e[1] for e in listed]) if listed else np.zeros(0)
        common = np.flatnonzero(np.bincount(term, minlength=n_terms) * COMMON >= max(1, len(listed)))
        self.row_of = np.full(n_terms, -1, np.int64)
        self.row_of[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(listed)))
        own = self.row_of[term] >= 0
        self.rows[self.row_of[term[own]], entry[own]] = weight[own]
        entry, term, weight = entry[~own], term[~own], weight[~own]
        order = np.lexsort((entry, term))
        self.entry, self.weight, term = entry[order].astype(np.int32), weight[order], term[order]
        block = self.entry // BLOCK
        first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, np.int64)
        # a part: the postings of one term in one block
        self.part_block, self.part_start, self.part_size = (x.astype(np.int32) for x in (block[first], first, np.diff(np.append(first, len(term)))))
        self.part_most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.cuts = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.blocks = -(-len(listed) // BLOCK)
        self.block_start = np.arange(self.blocks) * BLOCK
        self.base = (self.toxic.sum() + self.blank[1]) / max(1, self.n.sum() + self.blank[0])
        self.postings_read = 0

    def common_sums(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each vector and entry the part of the cosine that comes from terms with full rows."""
        q = np.zeros((len(vectors), len(self.rows)))
        for i, (at, weight) in enumerate(vectors):
            row = self.row_of[at]
            q[i, row[row >= 0]] = weight[row >= 0]
        return q @ self.rows

    def _add(self, scores: np.ndarray, parts: np.ndarray, weight: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores with the postings of some blocks added up."""
        wanted = np.zeros(self.blocks, bool)
        wanted[blocks] = True
        own = wanted[self.part_block[parts]]
        parts, weight = parts[own], weight[own]
        size = self.part_size[parts]
        at = _ranges(self.part_start[parts], size)
        self.postings_read += len(at)
        return scores + np.bincount(self.entry[at], np.repeat(weight, size) * self.weight[at], minlength=len(scores))

    def nearest(self, at: np.ndarray, weight: np.ndarray, skip: int = -1, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` entries of greatest cosine over zero, to ``DIGITS`` digits (ties: the smallest document), and the cosines; one more if ``skip`` is given. sums: the vector's ``common_sums``."""
        k = self.k + (skip >= 0)
        if not len(self.n):
            return np.zeros(0, np.int64), np.zeros(0)
        scores = self.common_sums([(at, weight)])[0] if sums is None else sums
        size = self.cuts[at + 1] - self.cuts[at]
        parts, weight = _ranges(self.cuts[at], size), np.repeat(weight, size)
        bound = np.maximum.reduceat(scores, self.block_start) + np.bincount(self.part_block[parts], weight * self.part_most[parts], minlength=self.blocks)
        order, done = np.argsort(-bound, kind="stable"), 1 + -(-k // BLOCK)
        full = np.zeros(self.blocks, bool)
        full[order[:done]] = True
        scores = np.where(np.repeat(full, BLOCK)[: len(scores)], self._add(scores, parts, weight, order[:done]), scores)
        known = scores[np.repeat(full, BLOCK)[: len(scores)]]
        floor = np.partition(known, -k)[-k] if len(known) > k else 0.0
        rest = order[done:]
        rest = rest[(bound[rest] > 0) & (bound[rest] >= floor - 10.0**-DIGITS)]
        if len(rest):
            scores = self._add(scores, parts, weight, rest)
            full[rest] = True
        scores = np.where(np.repeat(full, BLOCK)[: len(scores)], np.round(scores, DIGITS), 0.0)  # other blocks have parts of cosines
        found = np.flatnonzero(scores > 0)
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], -k)[-k]]
        found = found[np.lexsort((self.doc[found], -scores[found]))][:k]
        return found, scores[found]

    def vote(self, at: np.ndarray, weight: np.ndarray, own: tuple[int, int] | None = None, sums: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """The weighted share of toxic examples among the nearest, drawn to the base rate by ``PRIOR``; own: (entry, label) to leave out."""
        skip, label = own if own else (-1, 0)
        if not len(at):
            n, toxic = self.blank[0] - (own is not None), self.blank[1] - label
            return (toxic + PRIOR * self.base) / (n + PRIOR), np.zeros(0, np.int64), np.zeros(0)
        found, cosine = self.nearest(at, weight, skip, sums)
        w = cosine / (np.maximum(0.0, 1 - cosine) + SOFT)
        n, toxic = self.n[found].astype(float), self.toxic[found].astype(float)
        if own:
            n[found == skip] -= 1
            toxic[found == skip] -= label
        share = np.divide(toxic, n, out=np.zeros_like(n), where=n > 0)
        w = w * (n > 0) * (1 + np.log(np.maximum(n, 1)))
        return float((w @ share + PRIOR * self.base) / (w.sum() + PRIOR)), found, cosine


@dataclass
class Model:
    """All that scoring needs."""

    vocabulary: Vocabulary
    examples: Examples
    votes: np.ndarray
    chances: np.ndarray

    def calibrated(self, vote: float) -> float:
        return float(np.clip(np.interp(vote, self.votes, self.chances), 0.0, 1.0)) if len(self.votes) else vote


def monotone(votes: np.ndarray, labels: np.ndarray, least: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """A rising curve from votes to shares of label 1, by pooling neighbours that fall."""
    if not len(votes):
        return np.zeros(0), np.zeros(0)
    order = np.argsort(votes, kind="stable")
    bins = np.array_split(order, max(1, len(order) // least))
    pools: list[list[float]] = []
    for b in bins:
        pools.append([float(votes[b].sum()), float(labels[b].sum()), float(len(b))])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    x = np.array([p[0] / p[2] for p in pools])
    y = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])
    y = np.maximum.accumulate(y) + np.arange(len(y)) * 1e-9
    if len(x) == 1:  # one level: the vote itself keeps the order
        return np.zeros(0), np.zeros(0)
    return np.concatenate([[0.0], x, [1.0]]), np.concatenate([[min(y[0], x[0])], y, [max(y[-1], x[-1])]])


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _parts(batches, column: int):
    for batch in batches:
        yield from cut_rows(batch, column, _PART_BYTES)
    release_memory()


def term_strength(n: np.ndarray, toxic: np.ndarray, rows: int, toxic_rows: int) -> np.ndarray:
    """|ln| of the odds of a toxic row among those with a term over the odds of all rows, after ``PRIOR_ROWS`` more at the base rate."""
    if not 0 < toxic_rows < rows:  # with one label nothing tells terms apart
        return np.zeros(len(n))
    base = toxic_rows / rows
    return np.abs(np.log((toxic + PRIOR_ROWS * base) / (n - toxic + PRIOR_ROWS * (1 - base)) * (1 - base) / base))


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, k: int = NEIGHBOURS) -> Model:
    """The model from ``labelled`` (integer id and label 0/1; nulls are ignored, of several labels the largest holds).

    An id that several texts have teaches by the one of the smallest hash. The first text of the sample
    is taken whatever its size. Ids without a text in ``docs`` teach nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    labels = labelled.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    sample = spark.createDataFrame(labels.orderBy(*order).limit(sample_rows).collect(), "id long, label int")  # sample_rows at most
    texts = _documents(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    one = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    one = written(one, "toxic-examples")
    sized = one.select("id", F.octet_length("text").cast("long").alias("n")).orderBy(*order).collect()  # sample_rows at most
    ends = np.cumsum([r["n"] for r in sized], dtype=np.int64)
    chosen = [r["id"] for r, end in zip(sized, ends, strict=True) if end <= sample_bytes or r is sized[0]]
    kept = one.join(F.broadcast(spark.createDataFrame([(i,) for i in chosen], "id long")), "id", "left_semi").orderBy("id").toArrow()  # sample_bytes at most
    ids, labels = kept.column("id").to_pylist(), np.array(kept.column("label").to_pylist(), np.int64)
    parts = [p.column(0) for b in kept.select(["text"]).cast(pa.schema([("text", pa.string())])).to_batches() for p in cut_rows(b, 0, _PART_BYTES)]
    found, at = [], 0
    for part in parts:  # the words of a part at a time, of all parts only the distinct ones
        row, term, _ = terms_of(part)
        found.append((row + at, term))
        at += len(part)
    row, term = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64 if i == 0 else np.uint64)]) for i in (0, 1))
    found.clear()
    terms, which = np.unique(term, return_inverse=True)
    strength = term_strength(np.bincount(which, minlength=len(terms)), np.bincount(which, labels[row], minlength=len(terms)), len(ids), int(labels.sum()))
    words = spark.sparkContext.broadcast(Vocabulary(terms, np.ones(len(terms))))

    def count_documents(batches):
        seen = np.zeros(len(words.value.terms) + 1, np.int64)
        for part in _parts(batches, 1):
            at = words.value.places(terms_of(part.column(1))[1])
            seen += np.bincount(at[at >= 0], minlength=len(seen))
            seen[-1] += part.num_rows  # the last place counts the documents
        own = np.flatnonzero(seen)
        for a in range(0, len(own), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(own[a : a + (1 << 16)].astype(np.int32)), pa.array(seen[own[a : a + (1 << 16)]])], ["at", "n"])

    df = np.zeros(len(terms) + 1)
    counted = texts.mapInArrow(count_documents, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # a row a term
    words.destroy()
    df[np.asarray(counted.column("at"))] = np.asarray(counted.column("n"))
    idf = lambda n: np.log((1 + df[-1]) / (1 + n)) + 1
    vocabulary = Vocabulary(terms, idf(df[:-1]) * (1 + strength**2), float(idf(1.0)))
    vectors = [v for part in parts for v in vocabulary.vectors(part)]
    index = Examples(vectors, labels.tolist(), ids, len(terms), k)
    owns = list(zip(index.of.tolist(), labels.tolist(), strict=True))
    firsts, cached = list({own: i for i, own in enumerate(owns)}.values()), {}
    for a in range(0, len(firsts), _TOGETHER):
        part = firsts[a : a + _TOGETHER]
        for i, sums in zip(part, index.common_sums([vectors[i] for i in part]), strict=True):
            cached[owns[i]] = index.vote(*vectors[i], own=owns[i], sums=sums)[0]
    votes = np.array([cached[own] for own in owns], float)
    rarer = int(min(labels.sum(), len(labels) - labels.sum()))  # bins that the rarer label can fill, or no score could pass 0.5
    x, y = monotone(votes, labels.astype(float), least=min(20, max(1, rarer // 2)))
    return Model(vocabulary, index, x, y)


EVIDENCE = "array<struct<doc_id:bigint,cosine:double,examples:bigint,toxic:bigint>>"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", evidence: int = 5) -> DataFrame:
    """All columns of ``docs`` in ``record``, with ``score`` (0 to 1) and ``evidence``: the nearest entries.

    Null and empty texts score as the examples without known terms do. Nulls in other columns, repeated
    rows and extra columns are passed through; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    record = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    shape = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("examples", pa.int64()), ("toxic", pa.int64())]))

    place = docs.columns.index(text_col)

    def texts_of(batch: pa.RecordBatch) -> pa.Array:
        return pc.struct_field(batch.column(0), [place]).cast(pa.string())

    def run(batches):
        m, memo = sent.value, {}
        for part in (p for batch in batches for p in cut_rows(batch, texts_of(batch), _PART_BYTES)):
            scores, why = [], []
            vectors = m.vocabulary.vectors(texts_of(part))
            keys = [xxh3_128_digest(at.tobytes() + weight.tobytes()) for at, weight in vectors]
            if len(memo) > _MEMO:
                memo.clear()
            new = {key: i for i, key in enumerate(keys) if key not in memo}
            places = list(new.values())
            for a in range(0, len(places), _TOGETHER):
                own = places[a : a + _TOGETHER]
                for i, sums in zip(own, m.examples.common_sums([vectors[i] for i in own]), strict=True):
                    vote, found, cosine = m.examples.vote(*vectors[i], sums=sums)
                    memo[keys[i]] = m.calibrated(vote), [{"doc_id": int(m.examples.doc[e]), "cosine": min(1.0, float(c)), "examples": int(m.examples.n[e]), "toxic": int(m.examples.toxic[e])} for e, c in zip(found[:evidence], cosine[:evidence], strict=True)]
            for key in keys:
                scores.append(memo[key][0])
                why.append(memo[key][1])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(why, shape)], ["record", "score", "evidence"])
        memo.clear()
        release_memory()

    return record.mapInArrow(run, StructType().add(record.schema["record"]).add("score", DoubleType()).add("evidence", StructType.fromDDL(f"e {EVIDENCE}")["e"].dataType))


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labelled rows that may be learnt from: crc32 of the id as text isn't divisible by 5."""
    return labels.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0)
