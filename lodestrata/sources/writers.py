"""Sinks: staged publication, several outputs from one pass, checked composition, journals."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import ContractError


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(frame: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Writes beside ``path`` and renames at the end, on any Hadoop file system: readers never see a table in part.

    A first publication is one rename. Where a table stands already it is moved aside first, so for that
    moment there is none; if the new one can't take its place, the old one is put back.
    """
    spark = frame.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    writer = frame.write.format(fmt)
    for key, value in ({"compression": "zstd"} | options if fmt == "parquet" else options).items():
        writer = writer.option(key, value)
    writer.save(staged)
    source, fs = _path(spark, staged)
    target, _ = _path(spark, path)
    old = _path(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")[0]
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(source, target):
        if fs.exists(old):
            fs.rename(old, target)
        fs.delete(source, True)
        raise ContractError(f"could not publish {path}")
    if fs.exists(old):
        fs.delete(old, True)
    return path


def publish_version(frame: DataFrame, path: str, keep: int = 2) -> str:
    """A new version of a table, seen at once or not at all: readers always find the last whole one (``current_version``).

    Every version is a folder of its own, named by its number; the one rename that gives it this name publishes it.
    The ``keep`` latest stay, so that those who read an earlier one can end.
    """
    spark = frame.sparkSession
    root, fs = _path(spark, path.rstrip("/"))
    staged = f"{path.rstrip('/')}/.staged-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(staged)
    while True:
        numbers = _versions(fs, root)
        number = max(numbers, default=0) + 1
        target = _path(spark, f"{path.rstrip('/')}/version-{number:08d}")[0]
        if not fs.exists(target) and fs.rename(_path(spark, staged)[0], target):
            break
        if not fs.exists(_path(spark, staged)[0]):
            raise ContractError(f"could not publish {path}")
    for old in sorted(numbers)[: max(0, len(numbers) + 1 - keep)]:
        fs.delete(_path(spark, f"{path.rstrip('/')}/version-{old:08d}")[0], True)
    return target.toString()


def _versions(fs, root) -> list[int]:
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return [int(n.removeprefix("version-")) for n in names if n.startswith("version-")]


def current_version(spark: SparkSession, path: str) -> DataFrame:
    """The last version that was published whole."""
    root, fs = _path(spark, path.rstrip("/"))
    numbers = _versions(fs, root)
    if not numbers:
        raise ContractError(f"{path} has no version")
    return spark.read.parquet(f"{path.rstrip('/')}/version-{max(numbers):08d}")


def publish_text_heavy(frame: DataFrame, path: str) -> str:
    """Parquet for texts that repeat: zstd and dictionary pages large enough to hold them."""
    return publish(frame, path, **{"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(64 << 20)})


def publish_outputs(frame: DataFrame, outputs: dict[str, Column | None], columns: dict[str, Sequence[str]] | None = None) -> list[str]:
    """Several tables from one computation: a path and a condition each (None: all rows)."""
    kept = frame.persist()
    try:
        return [publish(kept.select(*(columns or {}).get(p, frame.columns)) if c is None else kept.where(c).select(*(columns or {}).get(p, frame.columns)), p) for p, c in outputs.items()]
    finally:
        kept.unpersist()


def publish_partial(frame: DataFrame, path: str, failed: Column) -> str:
    """Good rows to ``path``; if any failed, to ``path``.partial instead, with the failed ones in ``path``.errors."""
    bad = frame.where(failed)
    if not bad.limit(1).count():
        return publish(frame, path)
    publish(bad, f"{path}.errors")
    return publish(frame.where(~failed), f"{path}.partial")


def compose(spark: SparkSession, shards: Sequence[str], path: str, expected: int, order: str | None = None) -> str:
    """One table of all shards, published only if it has the expected rows."""
    frame = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (spark.read.parquet(s) for s in shards))
    n = frame.count()
    if n != expected:
        raise ContractError(f"{n} rows instead of {expected}")
    return publish(frame.orderBy(order) if order else frame, path)


def append_journal(frame: DataFrame, path: str, batch: str | None = None) -> bool:
    """Entries added to a journal; what stands there stays. Returns whether any were added.

    batch: a name for these entries, kept in the column ``batch``. They come with one rename, and a batch that
    stands already isn't added again, so a job may be repeated after a failure.
    """
    if batch is None:
        frame.write.mode("append").json(path)
        return True
    target, fs = _path(frame.sparkSession, f"{path.rstrip('/')}/batch={batch}")
    if fs.exists(target):
        return False
    staged = f"{path.rstrip('/')}/.staged-{uuid.uuid4().hex}"  # names that begin with a point aren't read
    frame.write.json(staged)
    if not fs.rename(_path(frame.sparkSession, staged)[0], target):
        fs.delete(_path(frame.sparkSession, staged)[0], True)
        return False
    return True


def html_report(frame: DataFrame, path: str, title: str, order: Sequence[str]) -> str:
    """A table as an HTML page of one file, for reports: its rows must be few enough to read. Text is escaped."""
    def escaped(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(plain), F.lit(name))
        return text

    row = F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), escaped(F.col(f"`{c}`")), F.lit("</td>")) for c in frame.columns), F.lit("</tr>"))
    head = F.concat(F.lit("<!doctype html><meta charset=utf-8><title>"), escaped(F.lit(title)), F.lit("</title><table><tr>"), *(F.concat(F.lit("<th>"), escaped(F.lit(c)), F.lit("</th>")) for c in frame.columns), F.lit("</tr>"))
    rows = frame.select(F.struct(*order).alias("__place"), row.alias("value")).orderBy("__place").select("value")
    first = frame.sparkSession.range(1).select(head.alias("value"))
    last = frame.sparkSession.range(1).select(F.lit("</table>").alias("value"))
    return publish(first.union(rows).union(last).coalesce(1), path, "text")


def export_both(frame: DataFrame, path: str) -> list[str]:
    """The same rows as Parquet and as CSV with a header, nulls as empty cells."""
    flat = frame.select(*(F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in frame.dtypes))
    return [publish(frame, f"{path}.parquet"), publish(flat, f"{path}.csv", "csv", header="true", quote='"', escape='"', emptyValue='""', nullValue="")]


def make_private(spark: SparkSession, path: str) -> None:
    """Only the owner may read: 700 for folders, 600 for files."""
    root, fs = _path(spark, path)
    permission = spark._jvm.org.apache.hadoop.fs.permission.FsPermission

    def walk(status) -> None:
        fs.setPermission(status.getPath(), permission("700" if status.isDirectory() else "600"))
        if status.isDirectory():
            for child in fs.listStatus(status.getPath()):
                walk(child)

    walk(fs.getFileStatus(root))
