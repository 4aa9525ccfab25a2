"""Stages as a plan: fingerprints, receipts, and what of a range has to run."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.contracts import ContractError
from ..sources.writers import publish

COMPLETE, INCOMPLETE, MISMATCH = 0, 10, 20


@dataclass(frozen=True)
class Stage:
    """A named function of (spark, inputs by name) to one table."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    inputs: Sequence[str] = ()
    settings: dict = field(default_factory=dict)


def digest(value) -> str:
    """SHA-256 of canonical JSON."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def select_range(stages: Sequence[Stage], first: str | None = None, last: str | None = None) -> list[Stage]:
    """The stages from ``first`` to ``last``, in order."""
    names = [s.name for s in stages]
    for n in (first, last):
        if n is not None and n not in names:
            raise ContractError(f"no stage {n}")
    a, b = names.index(first) if first else 0, names.index(last) if last else len(names) - 1
    if a > b:
        raise ContractError("the range is empty")
    return list(stages[a : b + 1])


class Runner:
    """Runs stages into one folder; a stage with a receipt for the same settings and inputs is read, not run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def receipt(self, name: str) -> dict | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.receipt")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return json.loads(self.spark.read.text(f"{self.folder}/{name}.receipt").first()[0])

    def identity(self, stage: Stage) -> str:
        upstream = {}
        for name in stage.inputs:
            found = self.receipt(name)
            if found is None:
                raise ContractError(f"{stage.name} needs {name}, which has no receipt")
            upstream[name] = found["receipt_id"]
        return digest({"name": stage.name, "settings": stage.settings, "upstream": upstream})

    def check(self, stage: Stage) -> tuple[int, str]:
        """COMPLETE, INCOMPLETE or MISMATCH, and why."""
        found = self.receipt(stage.name)
        if found is None:
            return INCOMPLETE, "no receipt"
        if found["identity"] != self.identity(stage):
            return MISMATCH, "settings or inputs differ"
        if self.table(stage.name).count() != found["n_rows"]:
            return MISMATCH, "the table has other rows"
        return COMPLETE, "complete"

    def run(self, stages: Sequence[Stage]) -> list[str]:
        """Runs what isn't complete, in order; returns the names that ran. A mismatch is an error: use another folder."""
        ran = []
        for stage in stages:
            state, why = self.check(stage)
            if state == MISMATCH:
                raise ContractError(f"{stage.name}: {why}")
            if state == COMPLETE:
                continue
            identity = self.identity(stage)
            publish(stage.run(self.spark, {n: self.table(n) for n in stage.inputs}), f"{self.folder}/{stage.name}.parquet")
            n = self.table(stage.name).count()
            body = {"name": stage.name, "identity": identity, "n_rows": n}
            body["receipt_id"] = digest(body)
            publish(self.spark.createDataFrame([(json.dumps(body),)], "value string").coalesce(1), f"{self.folder}/{stage.name}.receipt", "text")
            ran.append(stage.name)
        return ran
