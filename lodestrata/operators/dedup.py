"""Set operations and duplicates with a stated rule for which row stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contracts import demand_empty, repeated_keys


def distinct_or_conflict(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact duplicates dropped; a key with different rows is an error."""
    rows = frame.distinct()
    demand_empty(repeated_keys(rows, keys), "different rows for one key")
    return rows


def unique_combinations(frame: DataFrame, texts: Sequence[str], ids: Sequence[str], done: DataFrame | None = None) -> DataFrame:
    """One representative (the smallest ids) and the multiplicity of each combination of texts that isn't ``done`` yet."""
    rows = frame.where(" AND ".join(f"trim({t}) <> ''" for t in texts))
    found = rows.groupBy(*texts).agg(F.min(F.struct(*ids)).alias("__first"), F.count(F.lit(1)).alias("n_rows"))
    found = found.select(*texts, "__first.*", "n_rows")
    return found if done is None else found.join(done, list(texts), "left_anti")


def caseless(frame: DataFrame, column: str) -> DataFrame:
    """The distinct values of a text in lower case, and how many rows each has: ``n`` over 1 means repeated seeds."""
    return frame.groupBy(F.lower(column).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def overlap_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys are in both, only left, only right: one row."""
    a, b = left.select(key).distinct().withColumn("__a", F.lit(True)), right.select(key).distinct().withColumn("__b", F.lit(True))
    return a.join(b, key, "full").agg(F.count_if(F.col("__a") & F.col("__b")).alias("n_both"), F.count_if(F.col("__b").isNull()).alias("n_left"), F.count_if(F.col("__a").isNull()).alias("n_right"))


def earliest_round(frame: DataFrame, keys: Sequence[str], round_col: str) -> DataFrame:
    """Rows of the first round in which their key appears."""
    first = frame.groupBy(*keys).agg(F.min(round_col).alias(round_col))
    return frame.join(first, [*keys, round_col], "left_semi")


def unlabelled(frame: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys haven't been worked on yet."""
    return frame.join(done.select(*keys).distinct(), list(keys), "left_anti")


def import_judgments(pairs: DataFrame, earlier: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """``pairs`` with the latest earlier ``value`` of their keys and ``reused``: whether there is one; the others are left to judge."""
    known = earlier.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, at).alias(value))
    return pairs.join(known, list(keys), "left").withColumn("reused", F.col(value).isNotNull())


def resolve_rounds(frame: DataFrame, keys: Sequence[str], value: str, round_col: str) -> DataFrame:
    """The latest round's value of each key, and whether rounds disagreed."""
    return frame.groupBy(*keys).agg(F.max_by(value, round_col).alias(value), (F.countDistinct(value) > 1).alias("conflict"), F.max(round_col).alias(round_col))


def first_sentences(frame: DataFrame, person: str, order: Sequence[str], text: str, pattern: str = r"(?<=[.!?])\s+") -> DataFrame:
    """Person, order and ``deduplicated``: texts without sentences that stand earlier for the same person (by ``order``, then place), rejoined by one space. Texts without any left are dropped."""
    parts = frame.select(person, *order, F.posexplode(F.split(text, pattern)).alias("place", "__s")).withColumn("__t", F.trim("__s")).where("__t <> ''")
    rank = F.row_number().over(Window.partitionBy(person, "__t").orderBy(*order, "place"))
    kept = parts.withColumn("__r", rank).where("__r = 1").groupBy(person, *order).agg(F.array_sort(F.collect_list(F.struct("place", "__s"))).alias("__p"))
    return kept.select(person, *order, F.concat_ws(" ", F.col("__p.__s")).alias("deduplicated"))


def sorted_join(value: Column, separator: str = ";") -> Column:
    """Aggregate: the distinct values in order, joined."""
    return F.concat_ws(separator, F.array_sort(F.collect_set(value)))
