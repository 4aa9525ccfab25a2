"""Date functions: mixed formats, partial dates, ages, bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy", "yyyyMMdd")
DAYS_A_YEAR = 365.2425


def parse_day(text: Column, formats: Sequence[str] = FORMATS) -> Column:
    """The day of a date in any of several formats; null if none fits."""
    tidy = F.trim(text)
    return F.coalesce(*(F.to_date(F.try_to_timestamp(tidy, F.lit(f))) for f in formats))


def partial_bounds(text: Column) -> Column:
    """Struct (first, last): the days that 'YYYY-MM' or 'YYYY-MM-DD' covers; nulls for anything else."""
    tidy = F.trim(text)
    day = F.when(tidy.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(F.try_to_timestamp(tidy, F.lit("yyyy-MM-dd"))))
    month = F.when(tidy.rlike("^[0-9]{4}-[0-9]{2}$"), F.to_date(F.try_to_timestamp(F.concat(tidy, F.lit("-01")), F.lit("yyyy-MM-dd"))))
    return F.struct(F.coalesce(day, month).alias("first"), F.coalesce(day, F.last_day(month)).alias("last"))


def age_years(text: Column) -> Column:
    """The first 'age(d) N', in years or months and perhaps weeks; null outside 0..130; weeks need years and 0..51."""
    pattern = r"(?i)\bage(?:d)?\s+([0-9]+(?:\.[0-9]+)?)\s*(months?|years?)?(?:\s+and\s+([0-9]+)\s+weeks?\b)?"
    part = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))
    unit, weeks = F.lower(F.coalesce(part(2), F.lit(""))), part(3).try_cast("int")
    odd = part(3).isNotNull() & (~unit.startswith("year") | ~F.coalesce(weeks.between(0, 51), F.lit(False)))
    age = part(1).try_cast("double") / F.when(unit.startswith("month"), 12).otherwise(1) + F.coalesce(weeks, F.lit(0)) * 7 / DAYS_A_YEAR
    return F.when(odd, F.raise_error(F.lit("expected whole years and 0 to 51 weeks")).cast("double")).when(age.between(0, 130), age)


def decade(born: Column, at: Column) -> Column:
    """'40-49' and so on from the age in days over 365.25; 'Unknown' without a date."""
    low = F.floor(F.datediff(at, born) / F.lit(365.25) / 10) * 10
    return F.when(low.isNull() | (low < 0), "Unknown").otherwise(F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string")))


def day_bin(days: Column, edges: Sequence[int], labels: Sequence[str]) -> Column:
    """The label of the left-closed, right-open interval between neighbouring edges; null outside."""
    out = F.lit(None).cast("string")
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        out = F.when((days >= low) & (days < high), label).otherwise(out)
    return out


def earliest(*dates: Column) -> Column:
    """The earliest of several dates, nulls apart."""
    return F.least(*dates) if len(dates) > 1 else dates[0]


def latest_unless_open(closed: Column) -> Column:
    """Aggregate: the latest end, null if any end is missing."""
    return F.when(F.bool_or(closed.isNull()), F.lit(None)).otherwise(F.max(closed))
