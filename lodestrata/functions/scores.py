"""Scores and small formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_score(answers: Column) -> Column:
    """0 unless reasonable, else 1, plus 1 for each of three dimensions and 2 for the biomarker (a map of yes/no answers)."""
    yes = lambda k: F.coalesce(F.try_element_at(answers, F.lit(k)) == "yes", F.lit(False)).cast("int")
    return F.when(yes("reasonableness") == 0, 0).otherwise(1 + yes("cancer_type") + yes("burden") + yes("treatment_history") + 2 * yes("biomarker"))


def to_unit_range(score: Column, most: float) -> Column:
    """0..most as -1..1."""
    return score / F.lit(float(most)) * 2 - 1


def usage_cost(tokens_in: Column, cache_write: Column, cache_read: Column, tokens_out: Column, usd_in: float, usd_out: float) -> Column:
    """Dollars: input tokens, cache writes at 1.25 and reads at 0.1 of their price, output tokens; prices a million."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return ((zero(tokens_in) + 1.25 * zero(cache_write) + 0.1 * zero(cache_read)) * usd_in + zero(tokens_out) * usd_out) / 1e6


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1 - eps))
    return F.log(q / (1 - q))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def criteria_digest(items: Column) -> Column:
    """SHA-256 over the (heading, text, type) of a list of criteria, as JSON."""
    return F.sha2(F.to_json(F.transform(items, lambda i: F.struct(F.coalesce(i["heading"], F.lit("")), F.coalesce(i["text"], F.lit("")), F.coalesce(i["criterion_type"], F.lit(""))))), 256)
