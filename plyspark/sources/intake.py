"""Intake of log files, each line once: what is read from files and which files were read are one commit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.store import Store
from ..scratch import saved
from .logs import json_lines

LEDGER = "_files"


class ChangedFile(RuntimeError):
    """A file that was taken has another length now."""


class Unreconciled(RuntimeError):
    """Lines of a file are neither records nor rejected."""


@dataclass(frozen=True)
class Taken:
    """Of one intake: files, lines that aren't blank, records and rejected lines."""

    files: int = 0
    lines: int = 0
    records: int = 0
    rejected: int = 0


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, bytes) of the files of a folder and those below, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def _path(column: str) -> Column:
    """A file's path as the listing has it, of one that is encoded as in an address."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def take(store: Store, folder: str, table: str, schema: T.StructType, pattern: str = "*") -> Taken:
    """Appends the records of new files to ``table`` and their rejected lines to ``<table>_rejects``, with a row for each file in the ledger.

    All of it is one version of the store: an intake that fails, or that another one overtakes, leaves nothing, and can be run again.
    Files are known by path and are closed when they come: one whose length changed since raises ChangedFile. Each file's lines are
    counted apart from the reading of records, and must add up.
    """
    spark = store.spark
    with store.begin() as commit:
        now = listed(spark, folder, pattern)
        if commit.exists(LEDGER):
            known = commit.read(LEDGER).where(F.col("table") == table).select("path", F.col("bytes").alias("then"))
            changed = now.join(known, "path").where("bytes <> then").select("path").limit(5).collect()
            if changed:
                raise ChangedFile(", ".join(r.path for r in changed))
            now = now.join(known, "path", "left_anti")
        paths = [r.path for r in now.sort("path").collect()]
        if not paths:
            return Taken()
        records, rejects = json_lines(spark, paths, schema)
        commit.append(table, records.drop("_at"))
        commit.append(f"{table}_rejects", rejects)
        part = {t: commit.read(t, [commit.parts(t)[-1]]).groupBy(_path("_file").alias("path")).agg(F.count("*").alias(n)) for t, n in ((table, "records"), (f"{table}_rejects", "rejected"))}
        lines = spark.read.text(paths).where("trim(value) <> ''").groupBy(_path("_metadata.file_path").alias("path")).agg(F.count("*").alias("lines"))
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        files = now.join(lines, "path", "left").join(part[table], "path", "left").join(part[f"{table}_rejects"], "path", "left")
        ledger = saved(files.select("path", "bytes", F.lit(table).alias("table"), zero("lines"), zero("records"), zero("rejected"), F.current_timestamp().alias("taken_at")), "ledger")
        wrong = ledger.where("lines <> records + rejected").select("path").limit(5).collect()
        if wrong:
            raise Unreconciled(", ".join(r.path for r in wrong))
        commit.append(LEDGER, ledger)
        sums = ledger.agg(F.count("*"), F.sum("lines"), F.sum("records"), F.sum("rejected")).first()
    return Taken(*sums)
