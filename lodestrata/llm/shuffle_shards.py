"""Sharding by a two-pass external shuffle.

Pass one scatters the records of each shard uniformly, by seeded hashes, into buckets sized for
memory. Pass two takes a bucket at a time, puts it into an order of its own contents, runs a seeded
Fisher-Yates shuffle over it and writes it; buckets follow each other in their shard. The shard is
the highest of one hash for each shard number (rendezvous hashing), so it depends on the id and the
number of shards alone, and one more shard takes rows only into itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

SEED, BUCKET_BYTES, OVERHEAD = 42, 4 << 20, 8


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard of a key; a null key has one as well."""
    tickets = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("ticket"), s.alias("shard")))
    return F.array_max(tickets)["shard"]


def fisher_yates(n: int, seed: tuple[int, ...]) -> np.ndarray:
    """A seeded random order of ``n`` records."""
    order = list(range(n))
    draws = np.random.default_rng(seed).integers(0, np.arange(1, max(n, 1) + 1)).tolist()
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def write_shards(docs: DataFrame, out: str, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> StructType:
    """Writes whole records (column ``record``, all columns of ``docs``) to ``out``/shard=s with ``bucket`` and ``place``; returns the table's schema.

    Null ids and texts are records like any other. Records that repeat an id share its shard and are
    scattered over its buckets by all their columns; only wholly equal ones, that nothing tells apart,
    share a bucket, in whatever order. Buckets are sized by whole records (texts by their bytes, other
    columns by their JSON form). An empty table gives an empty one.
    """
    record = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"))
    key, text = F.col("record")[id_col], F.col("record")[text_col].cast("string")
    others = [F.col("record")[c] for c in docs.columns if c not in (id_col, text_col)]
    rest = F.coalesce(F.octet_length(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(others))))), F.lit(0)) if others else F.lit(0)
    plain = [F.to_json(F.struct(c.alias("c"))) if "map<" in kind else c for c, kind in ((F.col("record")[n], t) for n, t in docs.dtypes)]
    sized = record.select("record", shard_of(key, shards, seed).alias("shard"), F.xxhash64(*plain).alias("tie"), F.xxhash64(F.lit(seed), *plain).alias("tie2"), (F.coalesce(F.octet_length(text), F.lit(0)) + rest + OVERHEAD).cast("long").alias("size"))
    totals = {r["shard"]: r["n"] for r in sized.groupBy("shard").agg(F.sum("size").alias("n")).collect()}  # a row a shard
    buckets = F.element_at(F.create_map(*(F.lit(x) for s in range(shards) for x in (s, max(1, -(-totals.get(s, 0) // bucket_bytes))))), F.col("shard"))
    scattered = sized.select("record", "shard", "tie", "tie2", F.pmod(F.xxhash64("tie", F.lit(seed + 1)), buckets.cast("long")).cast("int").alias("bucket"))

    def shuffle(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("tie", "ascending"), ("tie2", "ascending")]))
        order = fisher_yates(table.num_rows, (seed, table["shard"][0].as_py(), table["bucket"][0].as_py())) if table.num_rows else np.zeros(0, np.int64)
        table = table.take(pa.array(order))
        return pa.table({"bucket": table["bucket"], "place": pa.array(np.arange(table.num_rows, dtype=np.int32)), "record": table["record"], "shard": table["shard"]})

    shape = StructType().add("bucket", IntegerType()).add("place", IntegerType()).add(scattered.schema["record"]).add("shard", IntegerType())
    shuffled = scattered.groupBy("shard", "bucket").applyInArrow(shuffle, shape)
    shuffled.write.partitionBy("shard").option("compression", "zstd").parquet(out)
    return shape


def read_shards(spark: SparkSession, out: str, schema: StructType | None = None) -> DataFrame:
    """``shard``, ``bucket``, ``place`` and ``record`` of written shards; with the schema, also of none."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(out)


def slots(read: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of the records, with ``shard`` and ``slot``: their place in the shard, without gaps from 0."""
    narrow = read.select(F.col("shard").cast("int").alias("shard"), "bucket", "place", *columns)
    sizes = read.select(F.col("shard").cast("int").alias("shard"), "bucket").groupBy("shard", "bucket").count()
    before = sizes.select("shard", "bucket", (F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).alias("before"))
    return narrow.join(before, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("place")).drop("bucket", "place", "before")
