"""Table contracts: columns, keys, cardinalities, and ledgers of what a filter left.

Checks are aggregates over keys (never a collect of rows) and return the offending keys as a
DataFrame; ``demand_empty`` turns such a table into an error with a few examples.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table that breaks its contract."""


def require_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``frame``, if it has all ``columns``."""
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return frame


def first_existing(frame: DataFrame, names: Sequence[str], required: bool = True) -> str | None:
    """The first of several names of a column that the table has."""
    found = next((n for n in names if n in frame.columns), None)
    if found is None and required:
        raise ContractError(f"none of the columns {', '.join(names)}")
    return found


def existing_columns(frame: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return frame.select(*(c for c in wanted if c in frame.columns))


def namespaced(frame: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """All columns but ``keep`` under a prefix."""
    return frame.withColumnsRenamed({c: f"{prefix}{c}" for c in frame.columns if c not in keep})


def line_items(frame: DataFrame, renames: dict[str, str], defaults: dict[str, object], required: str) -> DataFrame:
    """A view of line items: columns renamed (and only these), nulls by their defaults, rows whose ``required`` text is blank left out."""
    rows = frame.select(*(F.col(old).alias(new) for old, new in renames.items())).fillna(defaults)
    return rows.where(F.trim(F.coalesce(F.col(required), F.lit(""))) != "")


def demand_empty(violations: DataFrame, message: str) -> None:
    """An error if there is any row, with up to five of them."""
    rows = violations.limit(5).collect()
    if rows:
        raise ContractError(f"{message}: {'; '.join(str(r.asDict()) for r in rows)}")


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def validated_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", cardinality: str = "many_to_one") -> DataFrame:
    """An equi join whose key uniqueness is checked first: one_to_one, many_to_one, one_to_many or many_to_many."""
    one_left, one_right = cardinality.startswith("one"), cardinality.endswith("one")
    if one_left:
        demand_empty(repeated_keys(left, on), f"the left side repeats {list(on)}")
    if one_right:
        demand_empty(repeated_keys(right, on), f"the right side repeats {list(on)}")
    return left.join(right, list(on), how)


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_anti")


def split_conflicts(frame: DataFrame, key: str, split: str) -> DataFrame:
    """Keys that stand in more than one split."""
    return frame.groupBy(key).agg(F.countDistinct(split).alias("n_splits")).where("n_splits > 1")


def coverage_gaps(frame: DataFrame, group: str, kind: str, expected: dict[str, int]) -> DataFrame:
    """(group, kind, n) of all cells of the grid group x kind whose count isn't the expected one."""
    wanted = F.explode(F.create_map(*(F.lit(x) for pair in expected.items() for x in pair))).alias(kind, "wanted")
    grid = frame.select(group).distinct().select(group, wanted)
    counts = frame.groupBy(group, kind).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, [group, kind], "full").select(group, kind, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wanted", F.lit(0)).alias("wanted")).where("n <> wanted")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys whose named columns differ between two tables, nulls being equal; keys of one table only count."""
    a = before.select(*keys, F.struct(*columns).alias("before"))
    b = after.select(*keys, F.struct(*columns).alias("after"))
    return a.join(b, list(keys), "full").where(~F.col("before").eqNullSafe(F.col("after"))).select(*keys)


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One-to-one join of tables that share columns: these must agree and are kept once."""
    shared = [c for c in right.columns if c in left.columns and c not in on]
    both = validated_join(left, right.withColumnsRenamed({c: f"{c}__right" for c in shared}), on, cardinality="one_to_one")
    if shared:
        differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"{c}__right")) for c in shared))
        demand_empty(both.where(differs).select(*on), "shared columns disagree")
    return both.drop(*(f"{c}__right" for c in shared))


def attrition(steps: Sequence[tuple[str, DataFrame]], person: str) -> DataFrame:
    """A ledger: for each named step its rows and distinct persons, in order."""
    parts = [frame.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(person).alias("n_persons")).select(F.lit(i).alias("step_no"), F.lit(name).alias("step"), "n_rows", "n_persons") for i, (name, frame) in enumerate(steps)]
    return reduce(DataFrame.unionByName, parts)


def attrition_by_flags(frame: DataFrame, person: str, flags: Sequence[tuple[str, Column]]) -> DataFrame:
    """The same ledger for filters that are conditions on one table: one pass for all steps."""
    passed, counts = F.lit(True), []
    for i, (name, condition) in enumerate(flags):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.count_if(passed).alias("n_rows"), F.countDistinct(F.when(passed, F.col(person))).alias("n_persons")))
    return frame.agg(F.array(*counts).alias("steps")).select(F.inline("steps"))


def numbered_set_violations(frame: DataFrame, group: Sequence[str], number: str, count: str, multiple: str, text: str, split: str) -> DataFrame:
    """(group, rule) of sets whose rows aren't numbered 0..n-1, whose count or yes/no flag disagrees, whose text is empty, or that cross splits."""
    blank = F.col(text).isNull() | (F.trim(text) == "")
    facts = frame.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(number).alias("numbers"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.min(count).alias("count_low"),
        F.max(count).alias("count_high"),
        F.countDistinct(split).alias("splits"),
        F.count_if(blank).alias("blank"),
        F.count_if(~F.coalesce(F.col(multiple).isin("yes", "no"), F.lit(False))).alias("odd_flags"),
        F.count_if(F.col(multiple) == "yes").alias("yes"),
    )
    rules = {
        "numbers": (F.col("numbers") != F.col("n")) | (F.col("low") != 0) | (F.col("high") != F.col("n") - 1),
        "count": (F.col("count_low") != F.col("n")) | (F.col("count_high") != F.col("n")),
        "text": F.col("blank") > 0,
        "split": F.col("splits") > 1,
        "flag": F.col("odd_flags") > 0,
        "multiple": F.col("yes") != F.when(F.col("n") > 1, F.col("n")).otherwise(0),
    }
    broken = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in rules.items())), lambda x: x.isNotNull())
    return facts.select(*group, F.explode(broken).alias("rule"))


# The phases and the type of studies that count.
PHASES = ("EARLY_PHASE1", "PHASE1", "PHASE2", "PHASE3", "PHASE4")
STUDY_TYPE = "INTERVENTIONAL"


def eligible_studies(frame: DataFrame, key: str, posted: str, study_type: str, phases: str, start_year: int, *seed) -> DataFrame:
    """Studies first posted from a year on, of the type and with only known phases (one at least), with an 80/10/10 split by hash.

    A key with two different rows is an error; exact repeats count once.
    """
    from ..functions.dates import parse_day
    from ..functions.hashing import hash_fraction, split_of
    from .dedup import distinct_or_conflict

    rows = distinct_or_conflict(frame, [key])
    known = F.size(phases) > 0
    kept = rows.where((F.year(parse_day(F.col(posted))) >= start_year) & (F.upper(study_type) == STUDY_TYPE) & known & F.forall(phases, lambda p: p.isin(*PHASES)))
    return kept.withColumn("split", split_of(hash_fraction(*seed, F.col(key))))


def crosscheck_run(sources: DataFrame, decisions: DataFrame, sets: DataFrame, key: str, accepted: str, expected: dict[str, int] | None = None) -> DataFrame:
    """(problem, key) where a finished run's tables disagree.

    Every source needs one decision and the reverse; accepted keys need rows in ``sets``, others none;
    ``expected``: counts that a status file claims, by table name.
    """
    yes = decisions.where(accepted).select(key).distinct()
    checks = {
        "source without decision": missing_keys(sources, decisions, [key]),
        "decision without source": missing_keys(decisions, sources, [key]),
        "repeated decision": repeated_keys(decisions, [key]).select(key),
        "accepted without rows": missing_keys(yes, sets, [key]),
        "rows without acceptance": missing_keys(sets, yes, [key]),
    }
    found = [f.select(F.lit(name).alias("problem"), F.col(key).cast("string").alias("key")) for name, f in checks.items()]
    for name, table in {"sources": sources, "decisions": decisions, "sets": sets}.items():
        if expected and name in expected:
            found.append(table.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != expected[name]).select(F.lit(f"{name} count").alias("problem"), F.col("n").cast("string").alias("key")))
    return reduce(DataFrame.unionByName, found)


def without(frame: DataFrame, excluded: DataFrame | None, key: str, group: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows whose key isn't excluded and whose group name doesn't match; a null group stays."""
    out = frame if excluded is None else frame.join(excluded.select(key).distinct(), key, "left_anti")
    return out if pattern is None else out.where(~F.coalesce(F.col(group).rlike(pattern), F.lit(False)))
