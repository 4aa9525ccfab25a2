"""Joins on time and lineage: what stood before, nearest in a band, open at a date, filled from a map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written
from .windows import running_totals


def fill_from_map(frame: DataFrame, lookup: DataFrame, key: str, column: str, value: str, provenance: str, own: str = "own", filled: str = "lookup") -> DataFrame:
    """Nulls of ``column`` filled from ``lookup`` (key, value), and where each value came from."""
    joined = frame.join(lookup.select(key, F.col(value).alias("__value")), key, "left")
    source = F.when(F.col(column).isNotNull(), F.lit(own)).when(F.col("__value").isNotNull(), F.lit(filled))
    return joined.withColumn(provenance, source).withColumn(column, F.coalesce(column, "__value")).drop("__value")


def lineage(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, split: str) -> DataFrame:
    """Every child with all parents of its source key within its split."""
    renamed = parents.withColumnRenamed(parent_key, child_key) if parent_key != child_key else parents
    return children.join(renamed, [child_key, split])


def prior_counts(events: DataFrame, reports: DataFrame, person: str, cutoff: str, date: str, alias: str = "n_prior") -> DataFrame:
    """``events`` with the number of the person's reports strictly before ``cutoff``.

    Reports are counted by person and date first; a running sum over both tables' dates then replaces
    the range join, so a person's rows are sorted once instead of paired.
    """
    days = reports.where(F.col(date).isNotNull()).groupBy(person, F.col(date).alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    marks = events.select(person, F.col(cutoff).alias("__at")).distinct().withColumn("__n", F.lit(0).cast("long"))
    before = Window.partitionBy(person).orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = days.unionByName(marks).groupBy(person, "__at").agg(F.sum("__n").alias("__n"))
    counted = both.withColumn(alias, F.sum("__n").over(before) - F.col("__n")).select(person, F.col("__at").alias(cutoff), alias)
    return events.join(counted, [person, cutoff], "left").withColumn(alias, F.coalesce(alias, F.lit(0).cast("long")))


def before_cutoff(reports: DataFrame, events: DataFrame, person: str, date: str, cutoff: str) -> DataFrame:
    """Each report with each of its person's events whose cutoff is later (an equi join with a residual condition)."""
    return reports.join(events, person).where(F.col(date) < F.col(cutoff))


def nearest_in_band(left: DataFrame, right: DataFrame, on: Sequence[str], left_date: str, right_date: str, low: int, high: int, keys: Sequence[str]) -> DataFrame:
    """For each row of ``left`` (by ``keys``) the row of ``right`` whose date lies within low..high days of its own, nearest first, then earliest.

    Days are cut into steps as long as the band, and a band meets two of them at most: rows pair within a
    key's steps, not all of a key's rows.
    """
    width, day = high - low + 1, lambda c: F.unix_date(F.to_date(c))
    step = lambda d: F.floor(d / F.lit(width))
    steps = F.explode(F.array_distinct(F.array(step(day(left_date) + low), step(day(left_date) + high))))
    gap = F.datediff(F.col(right_date), F.col(left_date))
    joined = left.withColumn("__step", steps).join(right.withColumn("__step", step(day(right_date))), [*on, "__step"]).drop("__step")
    joined = joined.withColumn("gap_days", gap).where(F.col("gap_days").between(low, high))
    order = Window.partitionBy(*keys).orderBy(F.abs("gap_days"), F.col(right_date))
    return joined.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def open_counts(spans: DataFrame, days: DataFrame, opened: str, closed: str, day: str, n: str, name: str) -> DataFrame:
    """``spans`` with the sum of ``n`` over the days from ``opened`` to ``closed``; a missing end never closes, a missing start was always open.

    Running totals over the days and the ends of the spans: two equi joins instead of a range join.
    """
    number = lambda c: F.unix_date(F.col(c))
    spans = written(spans, "spans")  # read three times
    ends = [spans.select((number(opened) - 1).alias("__d"), F.lit(0).cast("long").alias("__n")), spans.select(number(closed).alias("__d"), F.lit(0).cast("long").alias("__n"))]
    marks = days.select(number(day).alias("__d"), F.col(n).cast("long").alias("__n")).unionByName(ends[0]).unionByName(ends[1]).where("__d IS NOT NULL")
    totals = written(running_totals(written(marks.groupBy("__d").agg(F.sum("__n").alias("__n")), "marks"), "__d", ["__n"]), "totals")  # a row a day
    at = lambda own: totals.select(F.col("__d").alias(own), F.col("cum___n").alias(f"{own}_n"))
    every = days.where(F.col(day).isNotNull()).agg(F.sum(n)).first()[0] or 0
    met = spans.withColumn("__low", number(opened) - 1).withColumn("__high", number(closed)).join(at("__low"), "__low", "left").join(at("__high"), "__high", "left")
    return met.withColumn(name, F.coalesce("__high_n", F.lit(every).cast("long")) - F.coalesce("__low_n", F.lit(0).cast("long"))).drop("__low", "__high", "__low_n", "__high_n")


def open_at(when: Column, opened: Column, closed: Column) -> Column:
    """Whether a window is open at a date; a missing end is open, a missing start too."""
    return F.coalesce(opened <= when, F.lit(True)) & F.coalesce(when <= closed, F.lit(True))


def window_flag(when: Column, low: Column, high: Column) -> Column:
    """Three-valued: null where the date or the window is unknown."""
    return F.when(when.isNull() | low.isNull() | high.isNull(), F.lit(None).cast("boolean")).otherwise(when.between(low, high))


def outside_years(opened: Column, closed: Column, first_year: int, last_year: int, status: Column, override: str) -> Column:
    """Whether a study was closed to a span of years; a missing side is open, and an override status is never outside."""
    outside = F.coalesce(F.year(closed) < first_year, F.lit(False)) | F.coalesce(F.year(opened) > last_year, F.lit(False))
    return outside & ~F.coalesce(status == override, F.lit(False))


def expand_distinct(frame: DataFrame, keys: Sequence[str], infer) -> DataFrame:
    """Runs ``infer`` (a function of a DataFrame of distinct keys) once a key and joins its result back to all rows."""
    return frame.join(infer(frame.select(*keys).distinct()), list(keys), "left")
