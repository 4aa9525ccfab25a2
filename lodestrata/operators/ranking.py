"""Ranked lists: exact similarity, top k, union of hits, re-ranking, one entry a parent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

QUERY_BLOCK_BYTES = 32 << 20


def top_k(frame: DataFrame, query: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each query with their 1-based rank; ``order`` must be total. Planned as a group limit before the shuffle."""
    return frame.withColumn(name, F.row_number().over(Window.partitionBy(*query).orderBy(*order))).where(F.col(name) <= k)


def top_ranks(frame: DataFrame, query: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """All rows of each query at the first ``k`` places; rows that ``order`` leaves equal share a place, and the next one is as far on as they are many."""
    return frame.withColumn(name, F.rank().over(Window.partitionBy(*query).orderBy(*order))).where(F.col(name) <= k)


def top_k_reversed(frame: DataFrame, query: Sequence[str], score: str, place: str, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each query by score, of equal scores the one that stands last: an ascending sort read from its end."""
    return top_k(frame, query, [F.desc(score), F.desc(place)], k, name)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers, in double."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _blocks(queries: DataFrame, dim: int, block_bytes: int) -> Iterator[tuple[list, list, np.ndarray]]:
    """Query ids, blocking keys and unit vectors, as many at a time as the block size allows."""
    most = max(1, block_bytes // (8 * max(1, dim)))
    held: list = []
    for row in queries.toLocalIterator():
        held.append(row)
        if len(held) == most:
            yield _matrix(held)
            held = []
    if held:
        yield _matrix(held)


def _matrix(rows: list) -> tuple[list, list, np.ndarray]:
    m = np.array([r["vector"] for r in rows], np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return [r["id"] for r in rows], [r["key"] for r in rows], m / np.where(norm == 0, 1, norm)


def similar_top_k(queries: DataFrame, items: DataFrame, id_col: str, vector_col: str, k: int, block_by: str | None = None, allow_self: bool = False, digits: int = 6, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """``query_id``, ``item_id``, ``score``, ``rank``: the exact k nearest items of a stated query set by cosine.

    Queries go out in blocks of bounded size; each task multiplies a block with its items and keeps k
    candidates a query, so what is shuffled is k rows a query and task. block_by: only items of the
    query's key. Scores are rounded to ``digits`` before ranking; ties go to the smaller item id. Null
    vectors match nothing.
    """
    spark = items.sparkSession
    shape = lambda f: f.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), (F.col(block_by).cast("string") if block_by else F.lit("")).alias("key"), F.col(vector_col).cast("array<double>").alias("vector"))
    queries, items = shape(queries), shape(items)
    order, done = [F.desc("score"), F.asc("item_id")], []
    first = queries.select(F.size("vector").alias("n")).first()
    found = None
    for ids, keys, matrix in _blocks(queries, first["n"] if first else 1, block_bytes):
        if found is not None:  # another block: what the last one found is written, so one block is held at a time
            done.append(written(top_k(found, ["query_id"], order, k).drop("rank"), "similar"))
            sent.unpersist()
        sent = spark.sparkContext.broadcast((np.array(ids), np.array(keys, object), matrix))

        def run(batches, sent=sent):
            ids, keys, matrix = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = batch.column(2)
                m = np.asarray(vectors.flatten()).reshape(batch.num_rows, -1)
                own = np.asarray(batch.column(0))
                norm = np.linalg.norm(m, axis=1, keepdims=True)
                scores = np.round(matrix @ (m / np.where(norm == 0, 1, norm)).T, digits) + 0.0
                if not allow_self:
                    scores[ids[:, None] == own[None, :]] = -np.inf
                scores[keys[:, None] != np.array(batch.column(1).to_pylist(), object)[None, :]] = -np.inf
                first_k = np.lexsort((np.broadcast_to(own, scores.shape), -scores), axis=1)[:, :k]
                best = np.take_along_axis(scores, first_k, 1)
                keep = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, keep.sum(1))), pa.array(own[first_k][keep]), pa.array(best[keep])], ["query_id", "item_id", "score"])

        found = items.mapInArrow(run, "query_id long, item_id long, score double")
    if found is None:
        found = spark.createDataFrame([], "query_id long, item_id long, score double")
    for part in done:
        found = found.unionByName(part)
    return top_k(found, ["query_id"], order, k)


def merge_hits(hits: DataFrame, pair: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row a pair, with all its hits as a sorted array of structs ``sources``."""
    return hits.groupBy(*pair).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("sources"))


def rerank(hits: DataFrame, query: Sequence[str], score: str, rank: str, k: int | None = None) -> DataFrame:
    """``new_rank`` by score from the top, ties by the old rank, which stays; the first ``k`` if given."""
    out = hits.withColumn("new_rank", F.row_number().over(Window.partitionBy(*query).orderBy(F.desc_nulls_last(score), F.col(rank))))
    return out if k is None else out.where(F.col("new_rank") <= k)


def best_per_parent(hits: DataFrame, query: str, parent: str, order: Sequence[Column], k: int) -> DataFrame:
    """The best hit of each parent in a query's list, then the first ``k`` parents."""
    best = top_k(hits, [query, parent], order, 1, "__parent_rank").drop("__parent_rank")
    return top_k(best, [query], order, k, "parent_rank")


def rank_bands(picks: DataFrame, by: Sequence[str], rank: str, bands: Sequence[tuple[int, int]]) -> DataFrame:
    """The share of picks whose original rank lies in each band."""
    return picks.groupBy(*by).agg(*(F.avg(F.col(rank).between(a, b).cast("double")).alias(f"share_{a}_{b}") for a, b in bands))
