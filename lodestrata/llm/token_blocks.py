"""Token ids as files of patched frame-of-reference blocks.

Documents are range-partitioned by id, encoded, each closed with the end id, and cut into segments
of some 260,000 ids. A segment's ids are split into blocks of 256. Of each block the minimum is
subtracted and the rest packed at the width that a percentile of its values needs; values that need
more bits keep their low bits there and put the others on the exception list. Block starts are
indexed, so one block can be read alone. Segments are rows of a Parquet table (the path may be any
store that Spark writes): ``part`` (the task), ``segment``, ``within`` (ids before it in its part), counts
and the segment's bytes.

Segment layout, little-endian: magic, documents, ids, blocks, exceptions, bytes of an id; document ids
(int64), their null marks (uint8), their lengths (uint32); block minima (uint32), widths (uint8),
exception counts (uint16), block starts (uint64); packed blocks; exception positions (uint8), exception
high bits (uint32).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import bounded_batches, cut_rows
from .bytewords import encoder
from .wordspans import utf8

BLOCK, PERCENTILE, SEGMENT_IDS, END_ID = 256, 0.95, 1 << 18, 2
PART_BYTES = 1 << 19
MAGIC = b"LSPF0001"
_HEAD = struct.Struct("<8sQQQQ")

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bit_width(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> dict[str, np.ndarray]:
    """The blocks of ``ids``: minima, widths, exception counts, starts, packed bytes, exception positions and high bits."""
    n = -(-len(ids) // BLOCK)
    values = np.empty(n * BLOCK, np.uint32)
    values[: len(ids)], values[len(ids) :] = ids, ids[-1] if len(ids) else 0
    values = values.reshape(n, BLOCK)
    least = values.min(1) if n else np.zeros(0, np.uint32)
    rest = values - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bit_width(np.partition(rest, rank, 1)[:, rank]) if n else np.zeros(0, np.uint8)
    high = rest >> width[:, None].astype(np.uint32)
    where = high > 0
    starts = np.concatenate([[0], np.cumsum(width.astype(np.uint64) * (BLOCK // 8))]).astype(np.uint64)
    out = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            bits = np.unpackbits(rest[own].astype("<u4").view(np.uint8).reshape(len(own), BLOCK, 4)[:, :, : (int(w) + 7) // 8], axis=2, bitorder="little")[:, :, :w]
            size = int(w) * BLOCK // 8
            out[(starts[own, None] + np.arange(size, dtype=np.uint64)).astype(np.int64)] = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
    return {"least": least, "width": width, "exceptions": where.sum(1).astype(np.uint16), "starts": starts[:-1], "packed": out, "positions": np.nonzero(where)[1].astype(np.uint8), "high": high[where]}


def unpack_blocks(parts: dict[str, np.ndarray], n_ids: int) -> np.ndarray:
    """The ids again."""
    width, starts = parts["width"], parts["starts"].astype(np.int64)
    values = np.zeros((len(width), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            size, full = int(w) * BLOCK // 8, (int(w) + 7) // 8
            bits = np.unpackbits(parts["packed"][starts[own, None] + np.arange(size)], axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            wide = np.zeros((len(own), BLOCK, 4), np.uint8)
            wide[:, :, :full] = np.packbits(bits, axis=2, bitorder="little")
            values[own] = wide.view("<u4")[:, :, 0]
    rows = np.repeat(np.arange(len(width)), parts["exceptions"])
    values[rows, parts["positions"]] |= parts["high"] << width[rows].astype(np.uint32)
    values += parts["least"][:, None]
    return values.ravel()[:n_ids]


_BLOCK_FIELDS = (("least", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("starts", "<u8"))


def segment_bytes(doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One segment file."""
    parts = pack_blocks(ids, percentile)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(parts["width"]), len(parts["high"]))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), lengths.astype("<u4").tobytes(), *(parts[k].astype(t).tobytes() for k, t in _BLOCK_FIELDS), parts["packed"].tobytes(), parts["positions"].tobytes(), parts["high"].astype("<u4").tobytes()])


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their null marks, lengths, and all ids of a segment file."""
    magic, docs, n_ids, blocks, exceptions = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of packed token ids")
    at = _HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    doc_ids, nulls, lengths = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs)
    parts = {k: take(t, blocks) for k, t in _BLOCK_FIELDS}
    parts["packed"] = take("u1", int(parts["width"].astype(np.int64).sum()) * BLOCK // 8)
    parts["positions"], parts["high"] = take("u1", exceptions), take("<u4", exceptions)
    return doc_ids, nulls, lengths, unpack_blocks(parts, n_ids)


def read_block(data: bytes, number: int) -> np.ndarray:
    """One block of a segment file, through the index of block starts."""
    _, docs, n_ids, blocks, exceptions = _HEAD.unpack_from(data)
    at = _HEAD.size + docs * 13
    field = {}
    for k, t in _BLOCK_FIELDS:
        field[k] = np.frombuffer(data, t, blocks, at)
        at += field[k].nbytes
    begin, w = int(field["starts"][number]), int(field["width"][number])
    end = at + int(field["width"].astype(np.int64).sum()) * BLOCK // 8
    skip, own = int(field["exceptions"][:number].sum(dtype=np.int64)), int(field["exceptions"][number])
    parts = {k: field[k][number : number + 1] for k in ("least", "width", "exceptions")} | {"starts": np.zeros(1, np.uint64), "packed": np.frombuffer(data, np.uint8, w * BLOCK // 8, at + begin)}
    parts |= {"positions": np.frombuffer(data, "u1", own, end + skip), "high": np.frombuffer(data, "<u4", own, end + exceptions + 4 * skip)}
    return unpack_blocks(parts, min(BLOCK, n_ids - number * BLOCK))


_TABLE = "part int, segment int, within long, n_docs long, n_ids long, data binary"


def write_tokens(docs: DataFrame, out: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, percentile: float = PERCENTILE, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes whole texts, each followed by ``end_id``, and writes them to ``out`` in ascending id order.

    Null and empty texts have the end id only. Ids are integers; null ids come first; rows that share an id all stay, in
    the order of a hash of their texts; an empty table gives an empty one; other columns aren't read.
    """
    path = path or default_path()
    bounded_batches(docs.sparkSession)
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    dealt = picked.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        code, part, number, within = encoder(path), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number, within
            doc_ids, lengths, flat = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            data = segment_bytes(doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False), lengths, flat, percentile)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([within]), pa.array([len(lengths)]), pa.array([len(flat)]), pa.array([data], pa.binary())], ["part", "segment", "within", "n_docs", "n_ids", "data"])
            held.clear()
            number, within = number + 1, within + len(flat)
            return row

        for batch in batches:
            for rows in cut_rows(batch, 1, PART_BYTES):
                ids, counts = code.encode(*utf8(rows.column(1)))
                held.append((rows.column(0), counts + 1, np.insert(ids, np.cumsum(counts), end_id)))
                if sum(len(h[2]) for h in held) >= segment_ids:
                    yield flush()
        if held:
            yield flush()

    dealt.mapInArrow(run, _TABLE).write.option("compression", "none").parquet(out)


def read_tokens(spark: SparkSession, out: str, id_name: str = "doc_id") -> DataFrame:
    """``id_name``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) from the files."""
    bounded_batches(spark)
    table = spark.read.schema(_TABLE).parquet(out)
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    starts = table.join(F.broadcast(before), "part").select((F.col("before") + F.col("within")).alias("start"), "data")  # a row for each task that wrote

    def run(batches):
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, nulls, lengths, ids = read_segment(data.as_py())
                ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                buffers = [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=nulls), pa.array(start + ends[:-1]), pa.array(lengths.astype(np.int64)), pa.Array.from_buffers(pa.binary(), len(lengths), buffers)],
                    ["id", "start", "n_tokens", "ids"],
                )

    return starts.mapInArrow(run, "id long, start long, n_tokens long, ids binary").withColumnRenamed("id", id_name)
