"""Ordered operators: first and last per key, running indices, monotone dates, interpolation, prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` must be total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_per_key(frame: DataFrame, keys: Sequence[str], at: Sequence[str], retract: Column | None = None) -> DataFrame:
    """The latest row of each key by an aggregate (no sort); keys whose latest row retracts vanish."""
    others = [c for c in frame.columns if c not in keys]
    latest = frame.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*at)).alias("__row")).select(*keys, "__row.*")
    return latest if retract is None else latest.where(~F.coalesce(retract, F.lit(False)))


RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 250_000, 64, 1024


def bucket_bounds(frame: DataFrame, order: str, buckets: int | None = None) -> list[float]:
    """Approximate quantiles of a numeric column, in one pass: ``buckets - 1`` numbers on the driver.

    Without a number of buckets there is one for each ``RANGE_ROWS`` rows, ``LEAST_RANGES`` at least and
    ``MOST_RANGES`` at most, so a range keeps its size up to some 250 million rows.
    """
    most = buckets or MOST_RANGES
    row = frame.agg(F.count(order).alias("n"), F.percentile_approx(order, [i / most for i in range(1, most)], 10 * most).alias("cuts")).first()
    wanted = buckets or min(MOST_RANGES, max(LEAST_RANGES, -(-row["n"] // RANGE_ROWS)))
    cuts = row["cuts"] or []
    return sorted({cuts[min(len(cuts) - 1, round(i * most / wanted) - 1)] for i in range(1, wanted)}) if cuts else []


def range_number(value: Column, bounds: Sequence[float]) -> Column:
    """How many bounds lie below the value, by halving: ten comparisons for a thousand bounds."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


def running_totals(frame: DataFrame, order: str, values: Sequence[str], buckets: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums ``cum_<value>`` over a global order, without sending all rows to one task.

    Rows are cut into ranges of ``order`` at approximate quantiles; sums within a range are added to
    the totals of the ranges before it. ``order`` should be distinct within ``by`` (aggregate first).
    """
    bounds = bucket_bounds(frame, order, buckets)
    cut = frame.withColumn("__bucket", range_number(F.col(order), bounds))
    totals = cut.groupBy(*by, "__bucket").agg(*(F.sum(v).alias(f"__t_{v}") for v in values))
    ranges = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    before = totals.select(*by, "__bucket", *(F.coalesce(F.sum(f"__t_{v}").over(ranges), F.lit(0)).alias(f"__b_{v}") for v in values))
    within = Window.partitionBy(*by, "__bucket").orderBy(order)
    joined = cut.join(before, [*by, "__bucket"])
    return joined.select(*frame.columns, *((F.col(f"__b_{v}") + F.sum(v).over(within)).alias(f"cum_{v}") for v in values))


def global_numbers(frame: DataFrame, order: str, name: str, buckets: int | None = None) -> DataFrame:
    """1-based numbers of rows with distinct numeric ``order``, by the same ranges."""
    return running_totals(frame.withColumn("__one", F.lit(1).cast("long")), order, ["__one"], buckets).withColumnRenamed("cum___one", name).drop("__one")


def monotone_offsets(offset: Column, partition: Sequence[str], order: Sequence[Column]) -> Column:
    """o[i] = max(o[i], o[i-1] + 1) in closed form: the running maximum of o[j] - j, plus i."""
    w = Window.partitionBy(*partition).orderBy(*order)
    index = F.row_number().over(w)
    return F.max(offset - index).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + index


def with_interpolated(frame: DataFrame, partition: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """``name``: ``value`` interpolated linearly on ``order``, held constant beyond the first and last known one."""
    w = Window.partitionBy(*partition).orderBy(order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    frame = frame.select("*", F.last(value, True).over(back).alias("__v0"), F.last(at, True).over(back).alias("__x0"), F.first(value, True).over(ahead).alias("__v1"), F.first(at, True).over(ahead).alias("__x1"))
    span = F.col("__x1") - F.col("__x0")
    line = F.col("__v0") + (F.col("__v1") - F.col("__v0")) * (F.col(order) - F.col("__x0")) / span
    out = F.when(F.col("__v0").isNull(), F.col("__v1")).when(F.col("__v1").isNull() | (span == 0), F.col("__v0")).otherwise(line)
    return frame.withColumn(name, out).drop("__v0", "__x0", "__v1", "__x1")


def order_breaks(frame: DataFrame, partition: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows whose value is below the one before it."""
    before = F.lag(value).over(Window.partitionBy(*partition).orderBy(order))
    return frame.withColumn("previous", before).where(F.col(value) < F.col("previous"))


def unique_ids(frame: DataFrame, key: str, order: Sequence[Column], name: str) -> DataFrame:
    """``name``: the key, with ``-2``, ``-3``, ... on its repeats."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return frame.withColumn("__n", n).withColumn(name, F.when(F.col("__n") > 1, F.concat_ws("-", F.col(key).cast("string"), F.col("__n").cast("string"))).otherwise(F.col(key).cast("string"))).drop("__n")
