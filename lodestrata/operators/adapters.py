"""Adapters: a name for each kind of task, and a function that makes its training examples of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import ContractError

Adapter = Callable[[DataFrame], DataFrame]
FIELDS = ("id", "prompt", "answer")


def adapter(id_col: Column, prompt: Column, answer: Column, where: Column | None = None) -> Adapter:
    """An adapter from three expressions; rows without a prompt or an answer aren't examples."""

    def make(frame: DataFrame) -> DataFrame:
        rows = frame if where is None else frame.where(where)
        return rows.select(id_col.cast("string").alias("id"), prompt.cast("string").alias("prompt"), answer.cast("string").alias("answer")).dropna()

    return make


def examples(adapters: dict[str, Adapter], tables: dict[str, DataFrame], tasks: Sequence[str] | None = None) -> DataFrame:
    """``task``, ``id``, ``prompt``, ``answer`` of all (or some) tasks, each from its table; an example that a task has twice counts once."""
    parts = []
    for task in tasks or list(adapters):
        if task not in adapters or task not in tables:
            raise ContractError(f"no adapter or no table for {task}")
        made = adapters[task](tables[task]).groupBy("id").agg(F.min(F.struct("prompt", "answer")).alias("__e"))
        parts.append(made.select(F.lit(task).alias("task"), "id", "__e.prompt", "__e.answer"))
    return reduce(DataFrame.unionByName, parts)
