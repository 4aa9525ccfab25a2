"""Benchmark decontamination by greedy string tiling.

Running Karp-Rabin hashes of ``seed`` words are joined between documents and benchmark items. For each
document and item that share enough of them, the longest common runs of words are marked, longest first
and never overlapping, until none of ``seed`` words is left. An item whose words are covered by at least
``coverage`` is in the document, in whatever order its passages stand. An item of fewer than ``seed`` words
is in a document that has all its words in a row.

Words are runs of anything but white space and ASCII punctuation, A-Z as a-z. Seeds are counted before
they are expanded: a document's distinct seeds give the covered words of each item at most, so a phrase
that thousands of items share costs an entry an item and document, however often the document
repeats it. Only pairs that can reach the coverage get their positions, and pairs with too many of those
are tiled by running hashes of falling lengths, in memory of the two texts.

The benchmark's index is broadcast in blocks of at most ``block_bytes`` of text (and one item at least).
A benchmark that fits into one block, as is checked by its size, takes one pass over the documents, which
never move. With more blocks, one pass picks the distinct texts that have any seed of the benchmark, by
a bit table of all blocks; only those meet the blocks one after another, and the hits go back by
the text's hashes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import bounded_batches, cut_rows, release_memory
from .storage import written
from .wordspans import folded_bytes, gram_hashes, utf8, word_hashes

SEED, COVERAGE, BLOCK_BYTES = 5, 0.6, 8 << 20
_PART_BYTES, _SIEVE, _AT_ONCE = 4 << 20, 22, 1 << 20


def _sieve_place(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - _SIEVE)).astype(np.int64)


def _within(at: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """Those of the positions from which ``n`` words lie in one row."""
    return at[at + n <= rows[np.searchsorted(rows, at, side="right")]]


def _spread(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers from each ``low`` on, ``n`` of them."""
    before = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(low - before[:-1], n) + np.arange(int(before[-1]))


@dataclass
class Seeds:
    """The runs of ``n`` words of some items: sorted hashes, where each stands, and a bit table of them."""

    n: int
    grams: np.ndarray
    at: np.ndarray
    sieve: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, n: int, words: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> Seeds:
        grams = gram_hashes(words, n)
        at = _within(np.arange(len(grams)), n, rows)
        at = at[wanted[np.searchsorted(rows, at, side="right") - 1]]
        at = at[np.argsort(grams[at], kind="stable")]
        sieve = np.zeros(1 << _SIEVE, bool)
        sieve[_sieve_place(grams[at])] = True
        return cls(n, grams[at], at, sieve)

    def hits(self, words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``words`` where a seed stands, its hash, and the range of its entries."""
        grams = gram_hashes(words, self.n)
        near = _within(np.flatnonzero(self.sieve[_sieve_place(grams)]), self.n, rows)
        low, high = np.searchsorted(self.grams, grams[near]), np.searchsorted(self.grams, grams[near], side="right")
        own = high > low
        return near[own], grams[near[own]], low[own], (high - low)[own]


@dataclass
class Index:
    """A block of the benchmark: words of its items, their seeds, and items shorter than a seed by their length."""

    ids: list
    words: np.ndarray
    rows: np.ndarray
    seed: int
    seeds: Seeds
    short: list[Seeds]

    @classmethod
    def of(cls, ids: list, texts: list[str], seed: int) -> Index:
        words, rows = word_hashes(*utf8(pa.array(texts, pa.string())), folded_bytes())
        size = np.diff(rows)
        short = [Seeds.of(n, words, rows, size == n) for n in range(1, seed) if (size == n).any()]
        return cls(ids, words, rows, seed, Seeds.of(seed, words, rows, size >= seed), short)

    def item(self, t: int) -> np.ndarray:
        return self.words[self.rows[t] : self.rows[t + 1]]

    def item_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.rows, at, side="right") - 1


def tiles(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """The tiles (start in doc, start in item, words) from all seeds at ``doc[i]`` and ``item[j]``: longest first, then by place in item and doc."""
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    first = np.concatenate([[True], (i[1:] - j[1:] != i[:-1] - j[:-1]) | (i[1:] != i[:-1] + 1)])
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, len(i))) + seed - 1  # neighbouring seeds make one run, as long as the words agree
    heap = list(zip((-length).tolist(), j[at].tolist(), i[at].tolist(), strict=True))
    heapq.heapify(heap)
    in_doc, in_item, free, marked = np.zeros(len(doc), bool), np.zeros(len(item), bool), len(item), []
    while heap and free >= 1:
        n, b, a = heapq.heappop(heap)
        n = -n
        taken = in_doc[a : a + n] | in_item[b : b + n]
        if not taken.any():
            in_doc[a : a + n], in_item[b : b + n] = True, True
            marked.append((a, b, n))
            free -= n
            continue
        turns = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for s, e in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            if e - s >= seed:
                heapq.heappush(heap, (s - e, b + s, a + s))
    return marked


def tiles_by_length(doc: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """The same tiles without a list of seeds: the longest length that free runs share, found by halving, then all tiles of that length."""
    in_doc, in_item, marked, top = np.zeros(len(doc), bool), np.zeros(len(item), bool), [], min(len(doc), len(item))

    def free_runs(words: np.ndarray, taken: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        before = np.concatenate([[0], np.cumsum(taken)])
        at = np.flatnonzero(before[n:] == before[:-n])
        return at, gram_hashes(words, n)[at]

    def share(n: int) -> bool:
        return bool(np.isin(free_runs(item, in_item, n)[1], free_runs(doc, in_doc, n)[1]).any())

    while top >= seed and share(seed):
        low, high = seed, top
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if share(middle) else (low, middle - 1)
        at, grams = free_runs(doc, in_doc, low)
        order = np.argsort(grams, kind="stable")
        at, grams = at[order], grams[order]
        own, own_grams = free_runs(item, in_item, low)
        left, right = np.searchsorted(grams, own_grams), np.searchsorted(grams, own_grams, side="right")
        following: dict[int, int] = {}  # a run that is taken stays taken
        for b, a, end in zip(own.tolist(), left.tolist(), right.tolist(), strict=True):
            if a == end or in_item[b : b + low].any():
                continue
            place = following.get(a, a)
            while place < end and in_doc[at[place] : at[place] + low].any():
                place += 1
            if place < end:
                start = int(at[place])
                in_doc[start : start + low] = in_item[b : b + low] = True
                marked.append((start, b, low))
            following[a] = place
        top = low - 1
    return marked


def _candidates(index: Index, row: np.ndarray, gram: np.ndarray, low: np.ndarray, n: np.ndarray, coverage: float) -> Iterator[tuple[int, int]]:
    """(row, item) of the pairs whose shared seeds cover enough of the item's words; distinct (row, gram) come in the order of rows."""
    at = 0
    ends = np.cumsum(n)
    while at < len(row):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, side="right"))
        to = int(np.searchsorted(row, row[min(max(to, at), len(row) - 1)]))  # whole rows, and one at least
        to = to if to > at else int(np.searchsorted(row, row[at], side="right"))
        places = index.seeds.at[_spread(low[at:to], n[at:to])]
        item, of = index.item_of(places), np.repeat(row[at:to], n[at:to])
        order = np.lexsort((places, item, of))
        places, item, of = places[order], item[order], of[order]
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (item[1:] != item[:-1])]) if len(of) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        step = np.where(new, index.seed, np.minimum(np.diff(places, prepend=0), index.seed))
        covered = np.add.reduceat(step, start) if len(start) else step
        size = np.diff(index.rows)[item[start]]
        enough = covered >= coverage * size
        yield from zip(of[start][enough].tolist(), item[start][enough].tolist(), strict=True)
        at = to


def _found(part: pa.Array, index: Index, coverage: float) -> Iterator[tuple[int, int, float, list]]:
    """(row, item, covered share, tiles) of the documents that hold enough of an item."""
    words, rows = word_hashes(*utf8(part), folded_bytes())
    for short in index.short:
        at, gram, low, n = short.hits(words, rows)
        row = np.searchsorted(rows, at, side="right") - 1
        _, first = np.unique(np.stack([row.astype(np.uint64), gram], 1), axis=0, return_index=True)
        for k in first.tolist():
            for t in index.item_of(short.at[low[k] : low[k] + n[k]]).tolist():
                yield int(row[k]), t, 1.0, [(int(at[k] - rows[row[k]]), 0, short.n)]
    at, gram, low, n = index.seeds.hits(words, rows)
    row = np.searchsorted(rows, at, side="right") - 1
    order = np.lexsort((gram, row))
    distinct = order[np.concatenate([[True], (row[order][1:] != row[order][:-1]) | (gram[order][1:] != gram[order][:-1])])] if len(order) else order
    for r, t in _candidates(index, row[distinct], gram[distinct], low[distinct], n[distinct], coverage):
        item, own = index.item(t), slice(*np.searchsorted(row, [r, r + 1]))
        doc, i = words[rows[r] : rows[r + 1]], at[own] - rows[r]
        item_grams = gram_hashes(item, index.seed)
        j = np.argsort(item_grams, kind="stable")
        first, last = np.searchsorted(item_grams[j], gram[own]), np.searchsorted(item_grams[j], gram[own], side="right")
        if int((last - first).sum()) <= _AT_ONCE:
            marked = tiles(doc, item, np.repeat(i, last - first), j[_spread(first, last - first)], index.seed)
        else:
            marked = tiles_by_length(doc, item, index.seed)
        share = sum(x for _, _, x in marked) / len(item)
        if share >= coverage:
            yield r, t, share, marked


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark's items by blocks: ``id`` and ``text``."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    return [items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else items for b in range(blocks)]


def _index(block: DataFrame, seed: int) -> Index:
    rows = sorted(block.collect(), key=lambda r: (r["id"] is not None, r["id"], r["text"]))  # block_bytes of text at most, or an item
    return Index.of([r["id"] for r in rows], [r["text"] for r in rows], seed)


def _any_seed(blocks: list[DataFrame], seed: int) -> list[tuple[int, np.ndarray]]:
    """For each length of seeds a bit table of all blocks' seeds."""
    tables: dict[int, np.ndarray] = {}
    for block in blocks:
        index = _index(block, seed)
        for own in (index.seeds, *index.short):
            tables[own.n] = tables.get(own.n, False) | own.sieve
    return sorted(tables.items())


HITS = "array<struct<item:bigint,coverage:double,tiles:array<struct<doc_start:int,item_start:int,words:int>>>>"
_HIT = pa.list_(pa.struct([("item", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("words", pa.int32())])))]))


def _hits_of(part: pa.Array, index: Index, coverage: float) -> list[list]:
    hits: list[list] = [[] for _ in range(len(part))]
    for r, t, share, own in _found(part, index, coverage):
        hits[r].append({"item": index.ids[t], "coverage": share, "tiles": [{"doc_start": a, "item_start": b, "words": n} for a, b, n in own]})
    return hits


def _text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("key"), F.xxhash64(F.reverse(text), F.lit(7)).alias("key2")


def _hits_by_text(texts: DataFrame, blocks: list[DataFrame], seed: int, coverage: float) -> DataFrame:
    """``key``, ``key2`` and ``hits`` of the distinct ``text`` that hold an item of any of several blocks."""
    spark = texts.sparkSession
    tables = spark.sparkContext.broadcast(_any_seed(blocks, seed))  # a bit table for each of the lengths 1 to seed

    def pick(batches):
        for part in (p for batch in batches for p in cut_rows(batch, 0, _PART_BYTES)):
            words, rows = word_hashes(*utf8(part.column(0)), folded_bytes())
            keep = np.zeros(part.num_rows, bool)
            for n, sieve in tables.value:
                near = _within(np.flatnonzero(sieve[_sieve_place(gram_hashes(words, n))]), n, rows)
                keep[np.searchsorted(rows, near, side="right") - 1] = True
            yield part.filter(pa.array(keep))
        release_memory()

    picked = texts.mapInArrow(pick, "text string").select("text", *_text_keys(F.col("text")))
    picked = written(picked.groupBy("key", "key2").agg(F.first("text").alias("text")), "benchmark-candidates")
    parts = []
    for block in blocks:
        sent = spark.sparkContext.broadcast(_index(block, seed))  # a block at a time

        def run(batches, sent=sent):
            for part in (p for batch in batches for p in cut_rows(batch, 2, _PART_BYTES)):
                hits = _hits_of(part.column(2), sent.value, coverage)
                keep = pa.array([bool(h) for h in hits])
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(hits, _HIT)], ["key", "key2", "hits"]).filter(keep)
            release_memory()

        parts.append(written(picked.mapInArrow(run, f"key long, key2 long, hits {HITS}"), "benchmark-hits"))
        sent.destroy()
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("key", "key2").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col`` and ``hits``: the benchmark items that each row's whole text holds, with their tiles in words.

    Null and empty texts hold none; ids of any kind, null ids and repeated rows stay. Items have integer ids; items without words never match;
    items that repeat an id are items each for itself. Empty tables give no hits or no rows; other columns
    aren't read.
    """
    bounded_batches(docs.sparkSession)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks, kind = _blocks(benchmark, item_col, "text", block_bytes), dict(picked.dtypes)["id"]
    if not blocks:
        return picked.select(F.col("id").alias(id_col), F.expr(f"CAST(array() AS {HITS})").alias("hits"))
    if len(blocks) > 1:
        found = _hits_by_text(picked.select("text"), blocks, seed, coverage)
        keyed = picked.select("id", *_text_keys(F.col("text"))).join(found, ["key", "key2"], "left")
        return keyed.select(F.col("id").alias(id_col), F.coalesce("hits", F.expr(f"CAST(array() AS {HITS})")).alias("hits"))
    sent = docs.sparkSession.sparkContext.broadcast(_index(blocks[0], seed))  # at most a block

    def run(batches):
        for part in (p for batch in batches for p in cut_rows(batch, 1, _PART_BYTES)):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_hits_of(part.column(1), sent.value, coverage), _HIT)], ["id", "hits"])
        release_memory()

    return picked.mapInArrow(run, f"id {kind}, hits {HITS}").withColumnRenamed("id", id_col)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item. Cases are those of ``benchmark_hits``."""
    bounded_batches(docs.sparkSession)
    blocks = _blocks(benchmark, item_col, "text", block_bytes)
    if not blocks:
        return docs
    if len(blocks) > 1:
        text = F.col(f"`{text_col}`").cast("string")
        bad = _hits_by_text(docs.select(text.alias("text")), blocks, seed, coverage).select(F.struct("key", "key2").alias("bad"))
        record = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"), F.struct(*_text_keys(text)).alias("keys"))
        return record.join(bad, F.col("keys") == F.col("bad"), "left_anti").select("record.*")
    sent, at = docs.sparkSession.sparkContext.broadcast(_index(blocks[0], seed)), docs.columns.index(text_col)

    def run(batches):
        for part in (p for batch in batches for p in cut_rows(batch, at, _PART_BYTES)):
            keep = np.ones(part.num_rows, bool)
            for r, *_ in _found(part.column(at), sent.value, coverage):
                keep[r] = False
            yield part.filter(pa.array(keep))
        release_memory()

    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # whatever the names
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
