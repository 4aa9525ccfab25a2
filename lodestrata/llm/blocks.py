"""Blocks: bounded runs of documents that travel as one compressed row.

Operators that must bring something back to the words of whole documents (a flag, token ids) do it
block by block: a block sends its *distinct* keys to key buckets and gets one answer for each key, so
what is shuffled follows distinct keys a block, not words, and a key that a third of all rows share
costs one entry a block. Block ids come from the task that wrote them and are read back from the
written table, never computed twice.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB, unless the session says otherwise: 10,000 long texts are too many for one.

    A batch is held several times over, in the JVM's native memory and in the worker's, by each running task.
    The setting is read when a job runs, not when it is planned, so it can't be given back here.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def release_memory() -> None:
    """Gives back what a worker holds for later: workers wait between tasks beside the JVM."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def buckets(spark: SparkSession) -> int:
    """Key buckets: as many as shuffle partitions, which are set by the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_ids() -> Iterator[int]:
    """Ids that no other task of the job gives."""
    at = TaskContext.get().partitionId() << 33
    while True:
        yield at
        at += 1


def cut_rows(batch: pa.RecordBatch, column: int | pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with up to ``most`` bytes in a binary or text column (by place, or the column itself); one row at least."""
    lengths = pc.binary_length(batch.column(column) if isinstance(column, int) else column).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def blocks_of(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of one batch after another in blocks of up to ``most`` bytes in a text column; one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in cut_rows(batch, column, max(1, most // 4)):
            own = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and size + own > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def packed(batch: pa.RecordBatch) -> bytes:
    """A batch as compressed Arrow bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def pack_documents(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block`` (long) and ``payload``: all rows' ids and texts, null texts as empty ones."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        ids = block_ids()
        for part in blocks_of(batches, 1, block_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([next(ids)]), pa.array([packed(part)], pa.binary())], ["block", "payload"])
        release_memory()

    return picked.mapInArrow(run, "block long, payload binary")
