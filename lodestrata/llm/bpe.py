"""BPE encoding and decoding through a table of distinct words.

Texts are split once by the tokenizer's own rules. A block of documents keeps its words as positions
in its list of distinct words, and sends that list to word buckets; a bucket encodes each distinct
word once with the tokenizers library, whatever the number of blocks, and returns the ids in the
order of each list. The block joins them back by position. A bucket's lists are read one after another
and answered at once, so a task holds the bucket's distinct words and one list; there are as many buckets
as the size of the texts asks for.

Decoding joins ids with the table of (id, piece), whose number of rows is that of the vocabulary.
``decode`` sends the distinct ids of each block to that join. ``encode`` with ``decoded`` has the table
folded to one row, the pieces in the order of their ids: each block gets it by a broadcast join on the
tokenizer's name, and its ids meet their pieces by position. Joined texts are made by Arrow.

A block has up to ``block_bytes`` of text, or one document: the memory of a task follows the longest document.

Splitting uses Python's ``re`` for texts whose characters all lie in a checked set (ASCII, Latin
letters, common punctuation), for which the pattern below equals the tokenizer's; every other text is
normalised and split by the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_ids, blocks_of, bounded_batches, buckets, packed, release_memory, unpacked
from .storage import written

BLOCK_BYTES, BUCKET_TEXT = 12 << 20, 64 << 20
# The characters for which the patterns are known to agree, and of them the letters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = "\t\n\r\x20-\x7e¡-©«-±´¶-¸»¿-ÿ–—‘’“”…"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordSplitter:
    """A tokenizer file's special strings, normaliser and word rule; and the ids of single words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, normalizers

        self.tokenizer, self._single = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.tokenizer, self._single):  # unused here
            t.no_truncation()
            t.no_padding()
        self._single.normalizer = normalizers.Sequence([])
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
            raise ValueError("special tokens that depend on what stands around them are not supported")
        self._cut = re.compile("(%s)" % "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._plain = re.compile(f"[{PLAIN}]*")
        self._words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
        self._known = spec["normalizer"] == {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]} and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    def split(self, text: str) -> list[str]:
        """The words of a text, normalised; a special string is a word of its own."""
        if self._cut is None or "<|" not in text:
            return self._split(text)
        words = []
        for i, part in enumerate(self._cut.split(text)):
            words += [part] if i % 2 else self._split(part)
        return words

    def _split(self, text: str) -> list[str]:
        if self._known and (text.isascii() and text.isprintable() or self._plain.fullmatch(text)):
            return self._words.findall(text.lower())
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, all by the library."""
        found = self._single.encode_batch_fast(words, add_special_tokens=False)
        return [e.ids for e in found]


@lru_cache(2)
def splitter(path: str) -> WordSplitter:
    return WordSplitter(path)


class _Positions(dict):
    """A position for each distinct word, in the order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def _squeeze(values: np.ndarray, level: int = 3) -> bytes:
    """Compressed unsigned 32-bit values: their upper bytes apart, then the low bytes of small and of other values."""
    import zstandard

    values = values.astype("<u4")
    upper = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4)[:, 1:].T)
    low, small = values.astype(np.uint8), values < 256
    pack = zstandard.ZstdCompressor(level=level).compress
    parts = [pack(x.tobytes()) for x in (upper, low[small], low[~small])]
    return np.array([len(values), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


def _expand(data: bytes) -> np.ndarray:
    import zstandard

    n, *sizes = np.frombuffer(data, "<u8", 4).tolist()
    ends = 32 + np.cumsum([0, *sizes])
    unpack = zstandard.ZstdDecompressor().decompress
    upper, few, rest = (np.frombuffer(unpack(data[a:b]), np.uint8) for a, b in zip(ends, ends[1:], strict=False))
    out = np.zeros((n, 4), np.uint8)
    out[:, 1:] = upper.reshape(3, n).T
    small = ~out.any(1)
    out[small, 0], out[~small, 0] = few, rest
    return out.view("<u4").ravel()


def _split_block(part: pa.RecordBatch, words: WordSplitter, block: int, n: int) -> Iterator[pa.RecordBatch]:
    """One row with the documents as positions, and a row of distinct words for each bucket."""
    import zstandard

    seen = _Positions()
    at = [np.fromiter(map(seen.__getitem__, words.split(t.as_py())), np.int32) for t in part.column(1)]
    flat, listed = np.concatenate(at), list(seen)
    at = [len(a) for a in at]
    seen.clear()
    # frequent words get small positions; equally frequent ones, mostly seen once, are listed by spelling and compress better
    spelled = np.array(sorted(range(len(listed)), key=listed.__getitem__), np.int64)
    often = spelled[np.argsort(-np.bincount(flat, minlength=len(listed))[spelled], kind="stable")]
    rank = np.empty(len(listed), np.uint32)
    rank[often] = np.arange(len(listed))
    listed = [listed[i] for i in often.tolist()]
    bucket = np.fromiter((zlib.crc32(w.encode()) % n for w in listed), np.int64, len(listed))
    zip_ = zstandard.ZstdCompressor(level=6).compress
    document = packed(pa.RecordBatch.from_arrays([part.column(0), pa.array(at, pa.int64())], ["id", "n"]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([None], pa.int32()), pa.array([document], pa.binary()), pa.array([_squeeze(rank[flat], 6)], pa.binary()), pa.array([_squeeze(bucket)], pa.binary()), pa.array([None], pa.binary())],
        ["block", "bucket", "documents", "positions", "buckets", "words"],
    )
    order = np.argsort(bucket, kind="stable")
    own, cuts = np.unique(bucket[order], return_index=True)
    groups = [zip_("\n".join(listed[i] for i in g.tolist()).encode()) for g in np.split(order, cuts[1:])] if len(own) else []
    none = pa.nulls(len(own), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([block] * len(own), pa.int64()), pa.array(own, pa.int32()), none, none, none, pa.array(groups, pa.binary())], ["block", "bucket", "documents", "positions", "buckets", "words"])


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """``id_col`` and ``ids`` (array of int): what the tokenizers library gives with add_special_tokens=False.

    Null texts count as empty and have no ids; ids of rows are integers, null ones and repeated rows stay; an
    empty table gives an empty one; other columns aren't read. decoded: adds the column of ``decode``, whose pieces are joined
    once for each distinct word of a block instead of once for each id. ``path`` is a tokenizer file that all executors have.
    """
    path = path or default_path()
    spark = docs.sparkSession
    bounded_batches(spark)
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = picked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(buckets(spark), -(-size // BUCKET_TEXT))

    def split(batches):
        ids, words = block_ids(), splitter(path)
        for part in blocks_of(batches, 1, block_bytes):
            yield from _split_block(part, words, next(ids), n)
        release_memory()

    found = picked.mapInArrow(split, "block long, bucket int, documents binary, positions binary, buckets binary, words binary")
    table = written(found.withColumn("tokenizer", F.lit(path)), "bpe-words")

    def encode_buckets(batches):
        import zstandard

        unzip, words, at, known = zstandard.ZstdDecompressor().decompress, splitter(path), None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, bucket, data = (c[i].as_py() for c in batch.columns)
                if bucket != at:
                    at, known = bucket, {}
                listed = unzip(data).decode().split("\n")
                new = [w for w in listed if w not in known]
                for k in range(0, len(new), 20_000):
                    plain = [w for w in new[k : k + 20_000] if w not in words.special]
                    known.update(zip(plain, (np.array(x, np.int32) for x in words.encode_words(plain)), strict=True))
                known.update((w, np.array([words.special[w]], np.int32)) for w in new if w in words.special)
                found = [known[w] for w in listed]
                sizes, flat = np.fromiter(map(len, found), np.int64, len(found)), np.concatenate(found)
                row = [pa.array([block]), pa.array([bucket], pa.int32()), pa.array([_squeeze(sizes)], pa.binary()), pa.array([_squeeze(flat)], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["block", "bucket", "sizes", "ids"])
        release_memory()

    lists = table.where("words IS NOT NULL").select("block", "bucket", "words").repartition(n, "bucket").sortWithinPartitions("bucket", "block")
    answers = lists.mapInArrow(encode_buckets, "block long, bucket int, sizes binary, ids binary")
    documents = table.where("documents IS NOT NULL").select("block", "tokenizer", "documents", "positions", "buckets")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "sizes", "ids")).alias("answers"))

    def join_back(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _join_back({k: batch.column(k)[i] for k in batch.schema.names}, decoded)
        release_memory()

    joined = documents.join(answers, "block", "left").drop("block")
    if decoded:
        folded = pieces(spark, path).groupBy("tokenizer").agg(F.array_sort(F.collect_list(F.struct("id", "piece"))).alias("pieces"))
        joined = joined.join(F.broadcast(folded), "tokenizer").drop("tokenizer")
    else:
        joined = joined.drop("tokenizer")
    return joined.mapInArrow(join_back, "id long, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("id", id_col)


def _lists(flat: pa.Array, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat)


def _join_back(row: dict, decoded: bool, words_at_once: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """A block's documents with their ids, from its positions and the buckets' answers."""
    documents = unpacked(row["documents"].as_py())
    position, bucket = _expand(row["positions"].as_py()), _expand(row["buckets"].as_py())
    answers = sorted(row["answers"].as_py() or [], key=lambda a: a["bucket"])
    empty = [np.zeros(0, np.uint32)]
    size = np.concatenate([_expand(a["sizes"]) for a in answers] or empty).astype(np.int32)
    flat = np.concatenate([_expand(a["ids"]) for a in answers] or empty).astype(np.int32)
    answers.clear()
    place = np.empty(len(bucket), np.int32)  # where in the answers a word of the block's list stands
    place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket), dtype=np.int32)
    begin = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    if decoded:
        table = row["pieces"].values
        words = pc.binary_join(_lists(table.field("piece").take(pa.array(np.searchsorted(table.field("id").to_numpy(), flat))), begin), " ")
    ends = np.concatenate([[0], np.cumsum(documents.column(1).to_numpy())])
    at = 0
    while at < documents.num_rows:  # as many documents as have so many words, or one
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + words_at_once, side="right")) - 1)
        own = place[position[ends[at] : ends[to]]]
        cuts, n_ids = ends[at : to + 1] - ends[at], size[own]
        before = np.concatenate([[0], np.cumsum(n_ids, dtype=np.int64)])
        spread = np.repeat((begin[own] - before[:-1]).astype(np.int64), n_ids) + np.arange(int(before[-1]))
        out = [documents.column(0).slice(at, to - at), _lists(pa.array(flat[spread], pa.int32()), before[cuts])]
        if decoded:
            full = np.concatenate([[0], np.cumsum(n_ids > 0)])  # a word without ids leaves no gap
            out.append(pc.binary_join(_lists(words.take(pa.array(own[n_ids > 0])), full[cuts]), " "))
        yield pa.RecordBatch.from_arrays(out, ["id", "ids", "decoded"][: len(out)])
        at = to


@lru_cache(2)
def _vocabulary(path: str) -> list[tuple[int, str]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.decoder is not None:
        raise ValueError("this file's decoder changes pieces; only plain joining is supported")
    return sorted((i, piece) for piece, i in tokenizer.get_vocab(with_added_tokens=True).items())


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``piece`` and ``tokenizer`` (the path) of a vocabulary file: a table of that many rows."""
    return spark.createDataFrame([(i, piece, path) for i, piece in _vocabulary(path)], "id int, piece string, tokenizer string")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids", block_ids_most: int = 1 << 20) -> DataFrame:
    """``id_col``, ``ids_col`` and ``decoded``: the ids joined with the vocabulary's pieces, as the library's decode(skip_special_tokens=False).

    Null or empty ids give an empty text; an id that the vocabulary lacks is left out, as the library does.
    """
    path, spark = path or default_path(), encoded.sparkSession
    bounded_batches(spark)
    picked = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kinds = dict(picked.dtypes)

    def send(batches):
        numbers = block_ids()
        for batch in batches:
            ends, at = np.cumsum(pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block_ids_most, side="right")))
                part = batch.slice(at, to - at)
                distinct = pc.unique(pc.list_flatten(part.column(1))).drop_null()
                yield pa.RecordBatch.from_arrays([pa.array([next(numbers)]), pa.array([packed(part)], pa.binary()), _lists(distinct, np.array([0, len(distinct)]))], ["block", "rows", "distinct"])
                at = to

    blocks = written(picked.mapInArrow(send, f"block long, rows binary, distinct {kinds['ids']}"), "bpe-decode")
    named = blocks.select("block", F.explode("distinct").alias("id")).join(F.broadcast(pieces(spark, path).drop("tokenizer")), "id")
    named = named.groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, table = unpacked(batch.column(0)[i].as_py()), batch.column(1)[i].values
                flat, lengths = pc.list_flatten(part.column(1)), pc.list_value_length(part.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
                found = pc.index_in(flat, table.field("id").cast(flat.type)) if table is not None else pa.nulls(len(flat), pa.int32())
                there = found.is_valid().to_numpy(zero_copy_only=False)
                named = table.field("piece").take(found.drop_null()) if table is not None else pa.array([], pa.string())
                cuts = np.concatenate([[0], np.cumsum(there)])[np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pc.binary_join(_lists(named, cuts), " ")], ["id", "ids", "decoded"])

    joined = blocks.select("block", "rows").join(named, "block", "left").select("rows", "pieces")
    return joined.mapInArrow(run, f"id {kinds['id']}, ids {kinds['ids']}, decoded string").withColumnsRenamed({"id": id_col, "ids": ids_col})
