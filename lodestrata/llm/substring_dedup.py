"""Substring deduplication by relative Lempel-Ziv factors against all earlier documents.

A word is redundant if it lies in a window of ``window`` consecutive words that also starts in a
document with a smaller id. The reference is every document of the corpus, in blocks:

1. Each block indexes the anchors of its documents: the least running hash of ``gram`` words in each
   window, so equal windows have equal anchors. Anchors that only one document has can't factor.
2. Blocks send their phrases (windows) at shared anchors to buckets: hash, a second hash of other word
   hashes, document and place. Together the buckets index every reference block. Of equal phrases the
   smallest document's place is the source of all others.
3. Each document is parsed greedily from left to right. A factor begins where a phrase has a source in
   an earlier document and is copied from there word by word, as long as the next phrase's source is the
   next word of the same document; there it ends, and the next factor begins. At their boundaries
   factors overlap by less than a phrase, touch, or leave words that no source has: factors that touch
   or overlap merge into one span, the others don't.

Phrases are equal if both hashes are, 128 bits of independent hashes of the words; a bucket or block in
which the first agrees and the second doesn't tells them apart.

Memory is that of a block (a document longer than ``block_bytes`` is one by itself) and of a bucket; there
are as many buckets as the size of the texts asks for. A phrase that a third of all documents share
has one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, bounded_batches, buckets, pack_documents, release_memory, unpacked
from .storage import written
from .wordspans import gram_hashes, utf8, window_minima, word_hashes

WINDOW, GRAM, BUCKET_TEXT = 50, 12, 32 << 20
SEEDS = 42, 43
_LAST = np.iinfo(np.int64).max


class _Block:
    """The windows of a block's documents: two hashes, document, row and first word of each."""

    def __init__(self, payload: bytes, window: int, gram: int):
        self.batch = unpacked(payload)
        ids = self.batch.column(0)
        self.ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        self._words, self.rows = word_hashes(*utf8(self.batch.column(1)), seed=SEEDS[0])
        n = max(0, len(self._words) - window + 1)
        row = np.repeat(np.arange(len(self.ids)), np.diff(self.rows))[:n]
        self._own = np.arange(n) + window <= self.rows[row + 1]  # a window lies in one document
        self.first, self.row = np.flatnonzero(self._own), row[self._own]
        self.doc = self.ids[self.row]
        self.place = self.first - self.rows[self.row]
        self.window, self.gram = window, gram

    def anchors(self) -> np.ndarray:
        return window_minima(gram_hashes(self._words, self.gram), self.window - self.gram + 1)[self._own]

    def phrases(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the wanted windows."""
        other, _ = word_hashes(*utf8(self.batch.column(1)), seed=SEEDS[1])
        return gram_hashes(self._words, self.window)[self._own][wanted], gram_hashes(other, self.window)[self._own][wanted]

    def shared(self, anchors: np.ndarray) -> np.ndarray:
        """The windows at shared anchors."""
        return np.flatnonzero(np.isin(self.anchors(), anchors))


def _groups(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal phrases are neighbours, as they came, and where each group starts."""
    order = np.argsort(key, kind="stable")
    k, c = key[order], check[order]
    same = k[1:] == k[:-1]
    if (same & (c[1:] != c[:-1])).any():  # two phrases of one hash
        order = np.lexsort((check, key))
        k, c = key[order], check[order]
        same = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    return order, np.flatnonzero(np.concatenate([[True], ~same])) if len(key) else np.zeros(0, np.int64)


def _sources(key: np.ndarray, check: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each phrase the position of an equal one in the smallest document, the first of several."""
    by_doc = np.argsort(doc, kind="stable")
    order, starts = _groups(key[by_doc], check[by_doc])
    order = by_doc[order]  # within a group the smallest document comes first
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(order[starts], np.diff(np.append(starts, len(key))))
    return out


def _slim(values: np.ndarray) -> bytes:
    """Compressed numbers that mostly go up by little, or equal the one before."""
    import zstandard

    steps = np.diff(values.astype("<i8"), prepend=np.int64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _full(data: bytes) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(flat.reshape(8, -1).T).view("<i8").ravel())


_SENT = "bucket int, block long, keys binary, checks binary, docs binary, places binary"
_BACK = "block long, bucket int, docs binary, places binary"


def _message(block: int, bucket: int, keys: np.ndarray, checks: np.ndarray, docs: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    data = [keys.tobytes(), checks.tobytes(), _slim(docs), _slim(places)]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block]), *(pa.array([x], pa.binary()) for x in data)], ["bucket", "block", "keys", "checks", "docs", "places"])


def _dealt(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in order) of keys, by their remainders."""
    bucket = (key % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    own, cuts = np.unique(bucket[order], return_index=True)
    yield from zip(own.tolist(), np.split(order, cuts[1:]), strict=True) if len(own) else ()


def _by_bucket(answer):
    """Runs ``answer`` (block ids, keys, checks, docs, places of one bucket's messages) over rows that come sorted by bucket."""

    def run(batches):
        held, at = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, block, keys, checks, docs, places = (c[i].as_py() for c in batch.columns)
                if bucket != at and held:
                    yield from answer(at, held)
                    held = []
                at = bucket
                held.append((block, np.frombuffer(keys, np.uint64), np.frombuffer(checks, np.uint64), _full(docs), _full(places)))
        if held:
            yield from answer(at, held)
        release_memory()

    return run


def _back(block: int, bucket: int, docs: bytes, places: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bucket], pa.int32()), pa.array([docs], pa.binary()), pa.array([places], pa.binary())], ["block", "bucket", "docs", "places"])


def _shared(bucket: int, messages: list) -> Iterator[pa.RecordBatch]:
    """To each block its anchors that at least two documents have (in ``docs``, as they are)."""
    keys, several = np.concatenate([m[1] for m in messages]), np.concatenate([m[3] for m in messages])
    order = np.argsort(keys, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    count = np.diff(np.append(start, len(keys)))
    keep = np.empty(len(keys), bool)
    keep[order] = np.repeat((count > 1) | (np.maximum.reduceat(several[order], start) > 0), count)
    at = 0
    for m in messages:
        own = m[1][keep[at : at + len(m[1])]]
        at += len(m[1])
        if len(own):
            yield _back(m[0], bucket, own.tobytes(), b"")


def _earlier(bucket: int, messages: list) -> Iterator[pa.RecordBatch]:
    """To each block, in the order of its message, the source of each phrase: document (-1: none earlier) and how much further on in it."""
    key, check, doc, place = (np.concatenate([m[i] for m in messages]) for i in (1, 2, 3, 4))
    source = _sources(key, check, doc)
    found = np.where(doc[source] < doc, doc[source], -1)
    ahead = np.where(found >= 0, place[source] - place, 0)
    at = 0
    for m in messages:
        own = slice(at, at + len(m[1]))
        at += len(m[1])
        if (found[own] >= 0).any():
            yield _back(m[0], bucket, _slim(found[own]), _slim(ahead[own]))


def _factors(block: _Block, at: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(row, start, end, source document, source start) of the greedy parse; ``at``: windows with a source, in order."""
    row, start = block.row[at], block.place[at]
    goes_on = (row[1:] == row[:-1]) & (start[1:] == start[:-1] + 1) & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(at) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(at)) - 1
    return np.stack([row[first], start[first], start[last] + block.window, doc[first], place[first]], 1) if len(at) else np.zeros((0, 5), np.int64)


def _spans(factors: np.ndarray) -> list[list[int]]:
    """Factors of one document, merged where they touch or overlap at their boundaries."""
    out: list[list[int]] = []
    for start, end in factors[:, 1:3].tolist():
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _to_blocks(blocks: DataFrame, back: DataFrame, how: str) -> DataFrame:
    """The blocks with what the buckets returned to them."""
    parts = back.groupBy("block").agg(F.collect_list(F.struct("bucket", "docs", "places")).alias("back"))
    return blocks.join(parts, "block", how).select("block", "payload", "back")


_FACTOR = "start:bigint,end:bigint,source:bigint,source_start:bigint"


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id_col``, ``n_words``, ``spans`` (array of [start, end) in words that repeat), ``factors`` (the copies they are made of, each with the document and word it is copied from) and ``kept`` (the other words, joined by one space).

    Null and empty texts have no words. A null id comes after every other id, and rows with equal ids
    are not references of each other. Repeated rows all stay; ids are integers. An empty table gives an
    empty one; other columns aren't read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    gram = min(gram, window)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
    n = max(buckets(spark), -(-size // BUCKET_TEXT))
    blocks = written(pack_documents(docs, id_col, text_col, block_bytes), "substring-blocks")
    rows = lambda batches: (tuple(c[i].as_py() for c in batch.columns) for batch in batches for i in range(batch.num_rows))
    dealt = lambda sent: sent.repartition(n, "bucket").sortWithinPartitions("bucket", "block")

    def send_anchors(batches):
        for number, payload in rows(batches):
            block = _Block(payload, window, gram)
            key = block.anchors()
            order = np.argsort(key, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
            if len(key):
                doc, key = block.doc[order], key[order][start]
                several = (np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)).astype(np.int64)
                for b, own in _dealt(key, n):
                    yield _message(number, b, key[own], key[:0], several[own], several[:0])
        release_memory()

    shared = dealt(blocks.mapInArrow(send_anchors, _SENT)).mapInArrow(_by_bucket(_shared), _BACK)

    def candidates(payload, back):
        """A block, its windows at shared anchors, both hashes of them, which of them it sends, and the source of each within the block."""
        block = _Block(payload, window, gram)
        at = block.shared(np.concatenate([np.frombuffer(b["docs"], np.uint64) for b in back]))
        key, check = block.phrases(at)
        source = _sources(key, check, block.doc[at])
        return block, at, key, check, np.flatnonzero(source == np.arange(len(at))), source

    def send_phrases(batches):
        for number, payload, back in rows(batches):
            block, at, key, check, sent, _ = candidates(payload, back)
            for b, own in _dealt(key[sent], n):
                own = sent[own]
                yield _message(number, b, key[own], check[own], block.doc[at[own]], block.place[at[own]])
        release_memory()

    found = written(shared, "substring-anchors")
    earlier = dealt(_to_blocks(blocks, found, "inner").mapInArrow(send_phrases, _SENT)).mapInArrow(_by_bucket(_earlier), _BACK)

    def parse(batches):
        shapes = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.struct([(c.split(":")[0], pa.int64()) for c in _FACTOR.split(",")]))
        for _, payload, back, answers in rows(batches):
            if back:
                block, at, key, check, sent, source = candidates(payload, back)
                doc, place = block.doc[at], block.place[at].copy()
                answers = {a["bucket"]: a for a in answers or ()}
                for b, own in _dealt(key[sent], n):
                    if b in answers:
                        earlier, ahead = _full(answers[b]["docs"]), _full(answers[b]["places"])
                        own = sent[own]
                        place[own] = np.where(earlier >= 0, place[own] + ahead, place[own])
                        doc[own] = np.where(earlier >= 0, earlier, doc[own])
                doc, place = doc[source], place[source]
                copied = np.flatnonzero(doc < block.doc[at])
                factors = _factors(block, at[copied], doc[copied], place[copied])
            else:
                block = _Block(payload, window, gram)
                factors = np.zeros((0, 5), np.int64)
            cuts = np.searchsorted(factors[:, 0], np.arange(len(block.ids) + 1))
            spans, copies, kept = [], [], []
            for i, text in enumerate(block.batch.column(1)):
                own = factors[cuts[i] : cuts[i + 1]]
                merged = _spans(own)
                words = text.as_py().encode().split()
                spans.append([{"start": a, "end": b} for a, b in merged])
                copies.append([dict(zip(("start", "end", "source", "source_start"), f, strict=True)) for f in own[:, 1:].tolist()])
                if merged:
                    stay = np.ones(len(words), bool)
                    for a, b in merged:
                        stay[a:b] = False
                    words = compress(words, stay.tolist())
                kept.append(b" ".join(words))
            arrays = [block.batch.column(0), pa.array(np.diff(block.rows)), pa.array(spans, shapes[0]), pa.array(copies, shapes[1]), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "spans", "factors", "kept"])
        release_memory()

    both = found.groupBy("block").agg(F.collect_list(F.struct("docs")).alias("back")).join(earlier.groupBy("block").agg(F.collect_list(F.struct("bucket", "docs", "places")).alias("answers")), "block", "left")
    parsed = blocks.join(both, "block", "left").select("block", "payload", "back", "answers")
    parsed = parsed.mapInArrow(parse, f"id long, n_words long, spans array<struct<start:bigint,end:bigint>>, factors array<struct<{_FACTOR}>>, kept string")
    return parsed.withColumnRenamed("id", id_col)
