"""Token arrays: ids as packed bytes with an index, so that one example is a slice of a buffer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed_arrays(frame: DataFrame, id_col: str, ids_col: str, shard_rows: int = 10_000) -> DataFrame:
    """``shard``, ``ids`` (array of the rows' ids), ``starts`` (where each begins, and the end) and ``tokens`` (little-endian unsigned 32-bit).

    Rows are dealt to shards of some ``shard_rows`` by a hash of their id and ordered by id within one. A null array is
    an empty one.
    """
    n = max(1, -(-frame.count() // shard_rows))
    shaped = frame.select(F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("shard"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col).cast("array<bigint>"), F.array().cast("array<bigint>")).alias("ids"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        lengths = pc.list_value_length(table["ids"]).to_numpy()
        flat = pc.list_flatten(table["ids"]).to_numpy()
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        return pa.table({"shard": table["shard"][:1], "ids": pa.array([table["id"].to_pylist()], pa.list_(pa.int64())), "starts": pa.array([starts], pa.list_(pa.int64())), "tokens": pa.array([flat.astype("<u4").tobytes()], pa.binary())})

    return shaped.groupBy("shard").applyInArrow(pack, "shard int, ids array<bigint>, starts array<bigint>, tokens binary")


def array_slices(packed: DataFrame, wanted: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """``id_col`` and ``ids`` of packed arrays, of ``wanted`` ids only: the index is joined first, then slices are cut from the buffers."""
    index = packed.select("tokens", "starts", F.posexplode("ids").alias("place", id_col))
    if wanted is not None:
        index = index.join(wanted.select(id_col).distinct(), id_col, "left_semi")
    start, end = F.element_at("starts", F.col("place") + 1), F.element_at("starts", F.col("place") + 2)
    cut = index.select(id_col, F.substring("tokens", (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")).alias("cut"))
    return cut.select(id_col, _numbers(F.col("cut")).alias("ids"))


def _numbers(data):
    """Little-endian unsigned 32-bit numbers of a binary column, by its hex digits."""
    digits = F.hex(data)
    at = F.sequence(F.lit(0), (F.length(digits) / 8 - 1).cast("int"))
    pair = lambda i, k: F.substring(digits, (i * 8 + 7 - 2 * k).cast("int"), F.lit(2))
    return F.when(F.length(digits) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(at, lambda i: F.conv(F.concat(*(pair(i, k) for k in range(4))), 16, 10).cast("bigint")))
