"""Intermediate tables in the folder that all executors share.

An operator that needs a result more than once, or that iterates, writes it as Parquet to the folder
named by ``spark.checkpoint.dir`` and reads it back: the lineage is cut, and a lost executor costs no
more than a read. Only where the session names no folder (tests on one machine) is one made here.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="lodestrata-"))
        atexit.register(shutil.rmtree, _OWN_FOLDER[0], ignore_errors=True)
    return f"file://{_OWN_FOLDER[0]}"


def written_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/lodestrata/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a table in the shared folder: computed once, here, and read from there afterwards."""
    path = written_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Deletes all intermediate tables; frames that read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lodestrata")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
