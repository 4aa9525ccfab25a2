"""Near copies by SimHash, checked by exact Jaccard similarity of word shingles.

Rows with the same words (``wordspans``: A-Z folded, white space between) are one node, its number a hash
of the words. Candidates come from SimHash: a fingerprint has a bit for each of several hundred hash
functions, set where more than half of the distinct shingles have it set. Sets of similarity 0.8 differ
in about 0.15 of the bits. No exact pigeonhole scheme is of use there (at 16 of 64 bits its keys are a
few bits long), so a fingerprint has as many blocks as it takes for two such sets to agree on a whole one
but for a chance of ``MISS``; a block has so many bits that 16 to 32 unrelated fingerprints share its key.
Only pairs whose shingle sets have a Jaccard similarity of 4/5 or more are linked.

0. Fingerprints with one key meet in one task, which compares ``PRINT_BITS`` further bits and the
   numbers of shingles. Chains of at most ``FAR`` differing bits and sizes within 4/5, under whatever key, make groups of candidates: a node is a member of one group,
   so there is a row a node, however many keys it shares with others. A key with more than
   ``GROUP_ROWS`` rows is dealt out: see 2.
1. Every member of a group is compared with one member drawn for it: one pair a row, however large a
   group of copies is.
2. The members of a group that are not in one component yet meet, with their shingles, in one task. It
   goes from component to component through an inverted index of the members that aren't reached yet
   and returns the links of a spanning forest, never the pairs. A group with more than ``GROUP_BYTES`` of
   shingles is dealt out as pairs of chunks, so no task holds more than two chunks. Members that are
   linked with the drawn one don't meet one another: their chunks only meet those of the rest.
3. Components of all links.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .blocks import bounded_batches, cut_rows, release_memory
from .components import connected_components
from .storage import written
from .wordspans import folded_bytes, gram_hashes, mix, utf8, word_hashes

SHINGLE = 5
#: Chance that a pair of similarity 0.8 has no block in common. Shares of the bits in which such sets differ at most: many shingles (arc of the cosine 8/9 over pi, and a little), and few.
MISS, DIFFER, FEW, DIFFER_FEW = 1 / 14_000, 0.155, 48, 0.188
#: Bits that are compared within a key. Those of a pair of similarity 0.8 differ in 19 on average, by chance in more than 38 once in a million; unrelated ones in 38 or fewer three times in a million.
PRINT_BITS, FAR = 128, 38
GROUP_BYTES, GROUP_ROWS = 32 << 20, 20_000
_PART_BYTES, _LINKS = 1 << 20, 1 << 19


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> list[tuple[int, np.ndarray]]:
    """(hash of the words, distinct hashes of the shingles) of each text; fewer words than a shingle are one shingle, no words none."""
    words, at = word_hashes(*utf8(column), folded_bytes(punctuation=False))
    out = []
    for a, b in zip(at, at[1:], strict=False):
        own = words[a:b]
        grams = gram_hashes(own, min(shingle, len(own))) if len(own) else own
        out.append((xxh64_intdigest(own.tobytes()), np.unique(grams)))
    return out


def block_bits(rows: int) -> int:
    """The bits of a block: a few less than the number of rows has."""
    return min(24, max(8, rows.bit_length() - 5))


def n_blocks(bits: int, size: int) -> int:
    """How many blocks it takes for a set of so many shingles."""
    return math.ceil(math.log(MISS) / math.log1p(-((1 - (DIFFER_FEW if size <= FEW else DIFFER)) ** bits)))


@lru_cache(4)
def _factors(words: int) -> np.ndarray:
    return mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)


def simhash_bits(grams: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of the fingerprint, one a byte: 1 where more than half of the shingles' hashes have the bit set."""
    factors = _factors(-(-bits // 64))
    ones = np.zeros(64 * len(factors), np.int64)
    for at in range(0, len(grams), 255):  # so many fit a byte
        hashes = mix(grams[at : at + 255, None] * factors)
        ones += np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return (2 * ones > len(grams)).astype(np.uint8)[:bits]


def fingerprint(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``PRINT_BITS`` bits as two words, and the keys: each block's number and its ``bits`` bits; no keys without shingles."""
    if not len(grams):
        return np.zeros(2, np.uint64), np.zeros(0, np.uint64)
    n = n_blocks(bits, len(grams))
    found = simhash_bits(grams, PRINT_BITS + n * bits)
    keys = found[PRINT_BITS:].reshape(n, bits) @ (np.uint64(1) << np.arange(bits, dtype=np.uint64))
    return np.packbits(found[:PRINT_BITS], bitorder="little").view("<u8"), keys | (np.arange(n, dtype=np.uint64) << np.uint64(32))


def band_keys(grams: np.ndarray, bits: int = 8) -> np.ndarray:
    """The keys of a set's blocks; none without shingles."""
    return fingerprint(grams, bits)[1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _by_text(docs: DataFrame, text_col: str, bits: int | None = None) -> DataFrame:
    """``docs`` without its text, and ``node``, ``size`` and ``hashes``: all shingles, or, with the ``bits`` of a block, the keys, and the further bits as ``low`` and ``high``."""
    bounded_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != text_col]
    picked = docs.select(*others, F.col(text_col).cast("string").alias(text_col))
    words = ["low", "high"] if bits else []

    def run(batches):
        for part in (p for batch in batches for p in cut_rows(batch, len(others), _PART_BYTES)):
            found = shingle_sets(part.column(len(others)))
            prints = [fingerprint(g, bits) for _, g in found] if bits else []
            hashes = [h.view(np.int64) for h in ([k for _, k in prints] if bits else [g for _, g in found])]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array([_signed(n) for n, _ in found], pa.int64()), pa.array([len(g) for _, g in found], pa.int32()), pa.array(hashes, pa.list_(pa.int64())), *(pa.array([_signed(int(p[i])) for p, _ in prints], pa.int64()) for i in range(len(words)))],
                [*others, "node", "size", "hashes", *words],
            )
        release_memory()

    kinds = ", ".join(f"`{c}` {dict(picked.dtypes)[c]}" for c in others)
    return picked.mapInArrow(run, f"{kinds}, node long, size int, hashes array<bigint>" + "".join(f", {w} long" for w in words))


def _least_joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` rows the first one that the links (a, b) join it with."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], least)
        np.minimum.at(now, root[b], least)
        now = now[now]
        if np.array_equal(now, root):
            break
        root = now
    return root


def _joined(starts: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """For each row of keys that come one after another, the first row of its own key that chains of near fingerprints join it with."""
    root = np.arange(len(low))
    alike = lambda x, y: 5 * np.minimum(x, y) >= 4 * np.maximum(x, y)
    near = lambda i, j: (np.bitwise_count(low[i] ^ low[j]) + np.bitwise_count(high[i] ^ high[j]) <= FAR) & alike(shingles[i], shingles[j])
    small, end, pairs = np.repeat(sizes, sizes) <= 128, np.repeat(starts + sizes, sizes), []
    for shift in range(1, 128):
        i = np.flatnonzero(small[: len(low) - shift] & (np.arange(len(low) - shift) + shift < end[: len(low) - shift]))
        if not len(i):
            break
        pairs.append(np.stack([i, i + shift])[:, near(i, i + shift)])
    if pairs:
        root = _least_joined(*np.concatenate(pairs, axis=1), len(low))
    for at, size in zip(starts[sizes > 128].tolist(), sizes[sizes > 128].tolist(), strict=True):
        left = np.arange(at, at + size)
        while len(left):
            first, queue, left = left[0], [left[0]], left[1:]
            while queue and len(left):
                reached = near(left, queue.pop())
                root[left[reached]] = first
                queue.extend(left[reached].tolist())
                left = left[~reached]
    return root


def _near_links(batches):
    """Links (a, b) of the chains of near fingerprints under each key, as forests: a link less than nodes for each chain of a task."""
    kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 6
    links = np.zeros((2, 0), np.int64)

    def found(cols: list[np.ndarray]) -> np.ndarray:
        """Each member of a chain and the least one."""
        key, chunks, node, low, high = cols[0], cols[1], cols[2], cols[3].view(np.uint64), cols[4].view(np.uint64)
        if not len(key):
            return links[:, :0]
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (chunks[1:] != chunks[:-1])]))
        root = _joined(starts, np.diff(np.append(starts, len(key))), low, high, cols[5])
        least = node.copy()
        np.minimum.at(least, root, node)
        return np.stack([node, least[root]])[:, node != least[root]]

    def forest_of(links: np.ndarray) -> np.ndarray:
        names, at = np.unique(links, return_inverse=True)
        root = _least_joined(*at.reshape(links.shape), len(names))
        return np.stack([names, names[root]])[:, root != np.arange(len(names))]

    for batch in batches:
        cols = [np.concatenate([k, np.asarray(batch.column(i))]) for i, k in enumerate(kept)]
        if not len(cols[0]):
            continue
        cut = len(cols[0]) - int(((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])).sum())  # rows are sorted: those of the open key are the last
        kept = [c[cut:] for c in cols]
        links = np.concatenate([links, found([c[:cut] for c in cols])], axis=1)
        if links.shape[1] > _LINKS:
            links = forest_of(links)
            if 2 * links.shape[1] > _LINKS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["a", "b"])
                links = links[:, :0]
    links = forest_of(np.concatenate([links, found(kept)], axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], ["a", "b"])
    release_memory()


def dealt_out(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows (key, main, node, ...) of the keys of ``parts`` (key, n_main, n_rest: chunks of either kind), with the ``chunks`` that they go to.

    Two chunks meet under each number. All rows of a key that aren't ``main`` meet one another and all
    its rows; those that are don't meet one another.
    """
    count = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<bigint>"))
    chunk, n_main, n_rest = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("n_main")).otherwise(F.col("n_rest"))), F.col("n_main"), F.col("n_rest")
    with_main = F.transform(count("n_main"), lambda i: i * n_rest + chunk)
    with_rest = F.transform(F.filter(count("n_rest"), lambda j: j != chunk), lambda j: (n_main + F.least(j, chunk)) * n_rest + F.greatest(j, chunk))
    goes = F.when(F.col("main"), F.transform(count("n_rest"), lambda j: chunk * n_rest + j)).otherwise(F.concat(with_main, with_rest))
    return rows.join(parts, "key").withColumn("chunks", F.explode(goes)).drop("main", "n_main", "n_rest")


def near_members(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``node`` and ``key``: the groups that chains of near fingerprints (node, low, high, hashes, size) which share a block make; a row for each node that has a near one. Without ``size`` only bits are compared."""
    size = (F.col("size") if "size" in prints.columns else F.lit(1)).cast("long").alias("size")
    rows = prints.select(F.explode("hashes").alias("key"), F.lit(0).cast("long").alias("chunks"), "node", "low", "high", size)
    drawn = None
    if prints.count() > group_rows:
        hot = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows).select("key"), "near-hot-blocks")
        if hot.limit(1).count():
            own = written(rows.drop("chunks").join(hot, "key"), "near-hot-rows")
            draws = own.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", "key").alias("draw"), "node", "low", "high", "size")).alias("drawn"))
            main = F.bit_count(F.col("low").bitwiseXOR(F.col("drawn.low"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("drawn.high"))) <= FAR
            main &= 5 * F.least("size", "drawn.size") >= 4 * F.greatest("size", "drawn.size")
            own = written(own.join(draws, "key").select("key", "node", "low", "high", "size", F.col("drawn.node").alias("drawn"), main.alias("main")), "near-hot-rows")
            drawn = own.where("main AND node <> drawn").select(F.col("node").alias("a"), F.col("drawn").alias("b"))
            n = lambda kind: F.ceil(F.sum(kind.cast("long")) / F.lit(group_rows // 2))
            parts = written(own.groupBy("key").agg(n(F.col("main")).alias("n_main"), n(~F.col("main")).alias("n_rest")).where("n_rest > 0"), "near-hot-parts")
            rows = rows.join(hot, "key", "left_anti").unionByName(dealt_out(own.drop("drawn"), parts))
    links = rows.select("key", "chunks", "node", "low", "high", "size").repartition("key", "chunks").sortWithinPartitions("key", "chunks").mapInArrow(_near_links, "a long, b long")
    return connected_components(links if drawn is None else links.unionByName(drawn), "near-chains").select("node", F.col("component").alias("key"))


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of a Jaccard similarity of 4/5 or more."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"{c}_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(9 * common >= 4 * (F.size("a_set") + F.size("b_set"))).select("a", "b")


def forest(nodes: np.ndarray, components: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a Jaccard similarity of 4/5 or more that join all components which such links join."""
    sizes = np.array([len(x) for x in sets], np.int64)
    _, term = np.unique(np.concatenate(sets), return_inverse=True) if len(sets) else (None, np.zeros(0, np.int64))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    owner, n_terms = np.repeat(np.arange(len(sets)), sizes), int(term.max(initial=-1)) + 1
    _, components = np.unique(components, return_inverse=True)
    members = np.split(np.argsort(components, kind="stable"), np.cumsum(np.bincount(components))[:-1]) if len(sets) else []
    left, out = np.ones(len(sets), bool), []

    def index() -> tuple[np.ndarray, np.ndarray, int]:
        """The members not reached yet, by shingle."""
        own = np.flatnonzero(left[owner])
        own = own[np.argsort(term[own], kind="stable")]
        return owner[own], np.searchsorted(term[own], np.arange(n_terms + 1)), int(left.sum())

    entries, cuts, indexed = index()
    for start in range(len(members)):
        if not left[members[start][0]]:
            continue
        left[members[start]] = False
        queue = members[start].tolist()
        while queue and left.any():
            at = queue.pop()
            if 2 * int(left.sum()) < indexed:
                entries, cuts, indexed = index()
            own = term[ends[at] : ends[at + 1]]
            low, size = cuts[own], cuts[own + 1] - cuts[own]
            before = np.concatenate([[0], np.cumsum(size)])
            common = np.bincount(entries[np.repeat(low - before[:-1], size) + np.arange(int(before[-1]))], minlength=len(sets))
            near = np.flatnonzero(left & (9 * common >= 4 * (sizes + sizes[at])))
            _, first = np.unique(components[near], return_index=True)
            for j in near[first].tolist():
                out.append((int(nodes[at]), int(nodes[j])))
                left[members[components[j]]] = False
                queue += members[components[j]].tolist()
    return out


def _group_links(batches):
    """The forests of keys whose rows come one after another."""
    held: list[pa.RecordBatch] = []
    at = None

    def flush():
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        lists = rows["hashes"].combine_chunks()
        values, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
        found = forest(np.asarray(rows["node"]), np.asarray(rows["c"]), [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)])
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        key, chunks = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (chunks[1:] != chunks[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if low < high:
                now = (int(key[low]), int(chunks[low]))
                if now != at:
                    yield from flush()
                    at = now
                held.append(batch.slice(low, high - low))
    yield from flush()
    release_memory()


def near_copies(docs: DataFrame, row_col: str, text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``row_col`` and ``component`` (a number that near copies share) of every row.

    ``row_col`` tells texts apart: rows that share it have one text. Null texts count as empty; texts
    without words are copies of each other. An empty table gives an empty one.
    """
    rows = docs.select(row_col, text_col)
    marked = written(_by_text(rows, text_col, block_bits(rows.count())), "near-rows")
    first = [F.first(c).alias(c) for c in ("size", "hashes", "low", "high")]
    nodes = written(marked.groupBy("node").agg(F.min(row_col).alias(row_col), *first), "near-nodes")
    keys = near_members(nodes).join(nodes.select("node", row_col, "size"), "node")
    members = written(keys, "near-members")
    draws = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", "key").alias("draw"), "node", "size")).alias("drawn"))
    members = written(members.join(draws.select("key", F.col("drawn.node").alias("drawn"), F.col("drawn.size").alias("drawn_size")), "key"), "near-drawn")
    sets = _by_text(rows.join(members.select(row_col), row_col, "left_semi"), text_col)
    sets = written(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "near-sets")

    near_size = 5 * F.least("size", "drawn_size") >= 4 * F.greatest("size", "drawn_size")
    links = written(_alike(members.where("node <> drawn").where(near_size).select(F.col("node").alias("a"), F.col("drawn").alias("b")), sets), "near-links")

    linked = links.select(F.col("a").alias("node"), F.col("b").alias("c"))
    placed = members.join(linked, "node", "left").select("key", "node", "size", "drawn", F.coalesce("c", "node").alias("c"))
    placed = written(placed.withColumn("main", F.col("c") == F.col("drawn")).drop("drawn"), "near-placed")
    split = placed.where("NOT main").select("key").distinct()
    left = written(placed.join(split, "key", "left_semi"), "near-left")
    bytes_of = lambda kind: 8 * F.sum(F.when(kind, F.col("size")).otherwise(0))
    hot = left.groupBy("key").agg(bytes_of(F.col("main")).alias("main"), bytes_of(~F.col("main")).alias("rest")).where(F.col("main") + F.col("rest") > group_bytes)
    hot = written(hot.select("key", *(F.ceil(F.col(c) / F.lit(group_bytes // 2)).alias(f"n_{c}") for c in ("main", "rest"))), "near-hot")
    rows = left.select("key", F.lit(0).cast("long").alias("chunks"), "node", "c")
    if hot.limit(1).count():
        rows = rows.join(hot, "key", "left_anti").unionByName(dealt_out(left.drop("size"), hot))
    grouped = rows.join(sets, "node").select("key", "chunks", "node", "c", "hashes").repartition("key", "chunks").sortWithinPartitions("key", "chunks")
    more = written(grouped.mapInArrow(_group_links, "a long, b long"), "near-more")
    reached = connected_components(links.unionByName(more), "near-components")
    return marked.select(row_col, "node").join(reached, "node", "left").select(row_col, F.coalesce("component", "node").alias("component"))
