"""Scorers and encoders as parameters: any function of a batch of texts, called in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import expand_distinct


def scored(frame: DataFrame, inputs: Sequence[str], scorer: Callable[[pd.DataFrame], Sequence], name: str, kind: str, attempts: int = 3, valid: Callable[[object], bool] | None = None) -> DataFrame:
    """``frame`` with ``name`` (null if every attempt failed) and ``<name>_error``.

    The scorer gets a batch of the input columns and returns a value a row. Rows whose value isn't
    valid, and batches that raise, are tried again. Each distinct input is scored once.
    """
    shape = ", ".join(f"{c} {k}" for c, k in frame.select(*inputs).dtypes) + f", {name} {kind}, {name}_error string"

    def once(rows: pd.DataFrame) -> pd.DataFrame:
        values, errors = [None] * len(rows), ["not scored"] * len(rows)
        for _ in range(attempts):
            left = [i for i, e in enumerate(errors) if e is not None]
            if not left:
                break
            try:
                found = list(scorer(rows.iloc[left].reset_index(drop=True)))
            except Exception as e:  # noqa: BLE001  a scorer may fail in any way
                for i in left:
                    errors[i] = f"{type(e).__name__}: {e}"[:300]
                continue
            for i, v in zip(left, found, strict=True):
                if v is not None and (valid is None or valid(v)):
                    values[i], errors[i] = v, None
                else:
                    errors[i] = "not valid"
        return rows.assign(**{name: values, f"{name}_error": errors})

    def infer(distinct: DataFrame) -> DataFrame:
        return distinct.mapInPandas(lambda batches: map(once, batches), shape)

    return expand_distinct(frame, inputs, infer)


def encoded(frame: DataFrame, text: str, encoder: Callable[[Sequence[str]], np.ndarray], name: str = "vector") -> DataFrame:
    """``frame`` with a unit vector of each text (null for null or zero vectors), as an array of floats."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        m = np.asarray(encoder(texts.fillna("").tolist()), np.float32)
        norm = np.linalg.norm(m, axis=1)
        return pd.Series([None if t is None or not n else (row / n).tolist() for t, row, n in zip(texts, m, norm, strict=True)])

    return frame.withColumn(name, run(text))


def sample_means(frame: DataFrame, keys: Sequence[str], value: str, first: Sequence[str], order: str, sentinel: float = -1) -> DataFrame:
    """The mean of repeated samples of each key without sentinels (null if none is left), samples, and the first row's other columns."""
    kept = F.when(F.col(value) != sentinel, F.col(value).cast("double"))
    return frame.groupBy(*keys).agg(F.avg(kept).alias(value), F.count(kept).alias("n_valid"), F.count(F.lit(1)).alias("n_samples"), *(F.min_by(c, order).alias(c) for c in first))


def rule_counts(frame: DataFrame, by: Sequence[str], rules: dict[str, object]) -> DataFrame:
    """How many rows of each group break each rule (a condition), one row a group and rule."""
    cells = F.array(*(F.struct(F.lit(n).alias("rule"), F.count_if(c).alias("n"), F.count(F.lit(1)).alias("n_rows")) for n, c in rules.items()))
    return frame.groupBy(*by).agg(cells.alias("__c")).select(*by, F.inline("__c"))


def aligned(gold: DataFrame, outputs: dict[str, DataFrame], keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Gold rows with each model's value by a composite key, in the gold's order; a model's repeated key counts once (its smallest value)."""
    out = gold
    for name, frame in outputs.items():
        out = out.join(frame.groupBy(*keys).agg(F.min(value).alias(name)), list(keys), "left")
    return out.orderBy(order)


def task_report(frame: DataFrame, task: str, measures: dict[str, str], valid: str, tokens: Sequence[str] = ()) -> DataFrame:
    """For each task: rows, the share of valid ones, the mean of each measure over valid rows, mean token counts."""
    ok = F.col(valid)
    return frame.groupBy(task).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.coalesce(ok, F.lit(False)).cast("double")), 4).alias("valid_of_all"),
        *(F.round(F.avg(F.when(ok, F.col(c).cast("double"))), 4).alias(name) for name, c in measures.items()),
        *(F.round(F.avg(c)).cast("long").alias(f"mean_{c}") for c in tokens),
    )
