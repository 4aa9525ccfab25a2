"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are 64-bit majorities over the XXH64 of word shingles. Equal fingerprints are folded to
their smallest id first, so copies cost one row. A fingerprint is split into ``b`` blocks; two that
differ in at most ``d`` bits agree on at least ``b - d`` whole blocks, so each combination of ``b - d``
blocks is a join key. ``b`` follows the number of fingerprints, so that a key has more bits than
their logarithm and unrelated ones rarely meet. Rows of one key meet sorted in one task, which
compares them and returns a spanning forest of the links, not the pairs; keys with more rows than
``group_rows`` are dealt out as pairs of chunks, so that no task holds more than two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import bounded_batches, release_memory
from .components import connected_components
from .storage import written

BITS = 64
GROUP_ROWS = 20_000


def fingerprint_text(text: bytes, shingle: int = 4, seed: int = 42, step: int = 1 << 16) -> int:
    """The fingerprint of one UTF-8 text; 0 if it has no words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, step):
        h = np.fromiter((xxh64_intdigest(joined[s:e], seed) for s, e in zip(first[at : at + step], last[at : at + step], strict=True)), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``id_col`` and ``fingerprint`` (the 64 bits as a signed long) of each row; a null text counts as empty."""
    bounded_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            prints = np.fromiter((fingerprint_text(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fingerprint"])
        release_memory()

    return picked.mapInArrow(run, f"id {dict(picked.dtypes)['id']}, fingerprint long").withColumnRenamed("id", id_col)


def block_masks(rows: int, distance: int) -> list[int]:
    """The bits of each key: combinations of whole blocks, of more bits than ``rows`` has by a few."""
    for blocks in range(distance + 1, 17):
        cuts = [BITS * i // blocks for i in range(blocks + 1)]
        masks = [sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in own) for own in combinations(range(blocks), blocks - distance)]
        if min(m.bit_count() for m in masks) >= max(1, rows).bit_length() + 2 or blocks == 9:
            return masks
    raise AssertionError


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(prints: np.ndarray, distance: int, chunk: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Search from node to node: (node, nodes first reached from it). Nodes in one tree aren't compared again."""
    left = np.arange(len(prints))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(prints[left] ^ prints[node]) <= distance
            if near.any():
                reached, left = left[near], left[~near]
                queue.extend(reached.tolist())
                yield node, reached


def _links(batches, distance: int):
    """Links within each key of rows that come sorted by it; only a key's rows are held."""
    kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 5

    def found(cols: list[np.ndarray]):
        key = np.zeros(len(cols[0]), bool)
        if not len(key):
            return [], []
        key[0] = True
        for c in cols[:3]:
            key[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(key)
        sizes = np.diff(np.append(starts, len(key)))
        prints, ids, left, right = cols[3].view(np.uint64), cols[4], [], []
        small = np.repeat(sizes, sizes) <= 32
        end_of = np.repeat(starts + sizes, sizes)
        for shift in range(1, 32):
            i = np.flatnonzero(small[: len(key) - shift] & (np.arange(len(key) - shift) + shift < end_of[: len(key) - shift]))
            if not len(i):
                break
            i = i[np.bitwise_count(prints[i] ^ prints[i + shift]) <= distance]
            left.append(ids[i])
            right.append(ids[i + shift])
        for at, size in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
            own = ids[at : at + size]
            for node, reached in _forest(prints[at : at + size], distance):
                left.append(np.full(len(reached), own[node]))
                right.append(own[reached])
        return left, right

    def batch_of(pair):
        if pair[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in pair], ["a", "b"])

    for batch in batches:
        cols = [np.concatenate([k, np.asarray(batch.column(i))]) for i, k in enumerate(kept)]
        if not len(cols[0]):
            continue
        open_key = np.ones(len(cols[0]), bool)
        for c in cols[:3]:
            open_key &= c == c[-1]
        cut = len(open_key) - int(open_key.sum())  # rows are sorted, so the open key's rows are the last
        kept = [c[cut:] for c in cols]
        yield from batch_of(found([c[:cut] for c in cols]))
    yield from batch_of(found(kept))


def near_links(prints: DataFrame, distance: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) between ids of ``prints`` (id, fingerprint; one row a fingerprint) that connect all pairs within ``distance`` bits."""
    masks = block_masks(prints.count(), distance)
    keys = prints.select(F.col("fingerprint").alias("print"), "id", F.posexplode(F.array(*(F.col("fingerprint").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks))).alias("mask", "key"))
    hot = written(keys.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows), "simhash-hot")
    rows = keys.withColumn("chunks", F.lit(0).cast("long"))
    if hot.limit(1).count():
        chunks = F.ceil(F.col("n") / (group_rows // 2))
        dealt = keys.join(hot, ["mask", "key"]).withColumn("chunk", F.pmod(F.xxhash64("print"), chunks))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        pair = F.least("chunk", "other") * F.col("n") + F.greatest("chunk", "other")
        rows = keys.join(hot, ["mask", "key"], "left_anti").withColumn("chunks", F.lit(0).cast("long")).unionByName(dealt.select("print", "id", "mask", "key", pair.alias("chunks")))
    rows = rows.select(F.col("mask").cast("long").alias("mask"), "key", "chunks", "print", "id").repartition("mask", "key", "chunks").sortWithinPartitions("mask", "key", "chunks")
    return rows.mapInArrow(lambda batches: _links(batches, distance), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, distance: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``id_col``, ``fingerprint`` (signed long) and ``component_id`` (the smallest id reachable) of every row.

    Null texts count as empty; texts without words share fingerprint zero and so a component. A null
    id gets a fingerprint, takes no part in links and has a null component. Rows that repeat an id
    all stay; ids are integers. An empty table gives an empty one. Other columns aren't read.
    """
    marked = written(fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text", shingle, seed), "simhash-prints")
    folded = written(marked.where("id IS NOT NULL").groupBy("fingerprint").agg(F.min("id").alias("id")), "simhash-folded")
    same_id = marked.where("id IS NOT NULL").groupBy("id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).where("low <> high")  # an id given to different texts links them
    several = marked.join(same_id.select("id"), "id", "left_semi").join(folded.select("fingerprint", F.col("id").alias("first")), "fingerprint").select(F.col("id").alias("a"), F.col("first").alias("b"))
    links = near_links(folded, distance, group_rows).union(several.where("a <> b"))
    reached = connected_components(links, "simhash-components")
    roots = folded.join(reached, folded["id"] == reached["node"], "left").select("fingerprint", F.coalesce("component", "id").alias("component_id"))
    return marked.join(roots, "fingerprint", "left").select(F.col("id").alias(id_col), "fingerprint", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def hex_print(fingerprint: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
