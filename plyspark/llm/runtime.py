"""Saved intermediate tables in the folder that the cluster shares.

Everything that must survive a lost executor is written as Parquet below
``spark.checkpoint.dir`` and read back, which cuts the lineage.  Where the
setting is absent (tests, a notebook) a local folder is used, and only when
the master is local.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import free, shared_dir

__all__ = ["Scratch", "delete", "file_system", "free", "hadoop_path", "shared_dir", "table", "whole_row"]

#: Spark's own setting for removing a finished execution's shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound on a batch that goes to a Python worker (64 MB unless set), and what it is here: an executor and its workers hold each batch several times over.
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Spark's settings for plans that run inside."""
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Scratch:
    """Parquet tables of one run of an operator, below the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/plyspark/{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table; what its plan shuffled is let go of once it is written, since nothing reads that again. Batches for workers are small."""
        with settings(self.spark, {CLEANUP: "true", BATCH_BOUND: str(BATCH_BYTES)}):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that an operator's own columns clash with none of them; ``select("row.*")`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
