"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, in local mode only, a fresh folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="plyspark-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


def shared_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/plyspark/{label}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read back: computed once, whatever reads it, and safe from lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``frames`` has it (names are compared without case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
