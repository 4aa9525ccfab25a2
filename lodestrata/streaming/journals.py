"""Structured Streaming forms: the current state of a journal, first sights, windowed counts.

The batch operators remain the main path; these keep the same results for tables that grow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_table(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_a_batch: int = 100) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_a_batch).load(path)


def latest_state(stream: DataFrame, key: str, at: str, choice: str, retraction: str = "skip") -> DataFrame:
    """Update stream of each key's current entry (``key``, ``choice``, ``at``, ``live``): the latest by ``at`` wins, a retraction isn't live.

    State is one entry a key; entries older than the state change nothing, so late ones are harmless.
    """
    kinds = dict(stream.dtypes)
    shape = f"{key} {kinds[key]}, {choice} {kinds[choice]}, {at} {kinds[at]}, live boolean"
    state_shape = f"{choice} {kinds[choice]}, {at} {kinds[at]}"

    def fold(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else None
        changed = False
        for part in parts:
            last = part.sort_values(at).iloc[-1]
            if best is None or last[at] > best[1]:
                best, changed = (last[choice], last[at]), True
        if changed:
            state.update(best)
            yield pd.DataFrame({key: [keys[0]], choice: [best[0]], at: [best[1]], "live": [best[0] != retraction]})

    return stream.select(key, choice, at).groupBy(key).applyInPandasWithState(fold, shape, state_shape, "update", GroupStateTimeout.NoTimeout)


def first_sights(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """Rows whose key hasn't been seen within the delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, at: str, by: Sequence[str], width: str, delay: str, slide: str | None = None) -> DataFrame:
    """Counts in windows of event time; late rows within the delay still count."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    return stream.withWatermark(at, delay).groupBy(window, *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")
