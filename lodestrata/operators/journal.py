"""Journals and judged units: latest entries, statuses, gold values, agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import latest_per_key


def current_entries(journal: DataFrame, key: Sequence[str], at: Sequence[str], choice: str, retraction: str = "skip") -> DataFrame:
    """The latest entry of each key; a latest entry that retracts removes the key."""
    return latest_per_key(journal, key, at, F.col(choice) == retraction)


def unit_status(a: Column, b: Column) -> Column:
    """Of two judges' values: agreed, disputed, single (one answered) or missing (none)."""
    n = F.when(a.isNotNull(), 1).otherwise(0) + F.when(b.isNotNull(), 1).otherwise(0)
    return F.when((n == 2) & (a == b), "agreed").when(n == 2, "disputed").when(n == 1, "single").otherwise("missing")


def gold(adjudicated: Column, a: Column, b: Column) -> Column:
    """The adjudicated value, else the one that both judges gave, else null."""
    return F.coalesce(adjudicated, F.when(a == b, a))


def agreement(units: DataFrame, kind: str, a: str, b: str, gold_col: str, status: str) -> DataFrame:
    """For each kind: units, statuses, raw agreement and each judge's accuracy against gold."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    right = lambda c: F.avg(F.when(F.col(c).isNotNull() & F.col(gold_col).isNotNull(), (F.col(c) == F.col(gold_col)).cast("double")))
    return units.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(status) == s).alias(f"n_{s}") for s in ("agreed", "disputed", "single")), F.avg(F.when(both, (F.col(a) == F.col(b)).cast("double"))).alias("agreement"), right(a).alias("accuracy_a"), right(b).alias("accuracy_b"), F.count_if(both & (F.col(a) == F.col(b)) & (F.col(a) != F.col(gold_col))).alias("n_both_wrong"))


def worst(values: Column, order: Sequence[str]) -> Column:
    """Aggregate: the value that stands last in ``order``."""
    rank = F.coalesce(*(F.when(values == v, F.lit(i)) for i, v in enumerate(order)))
    return F.max_by(values, rank)


def transitions(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """How often each old value became each new one."""
    return before.select(key, F.col(value).alias("old")).join(after.select(key, F.col(value).alias("new")), key).groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"))
