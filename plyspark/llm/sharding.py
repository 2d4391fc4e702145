"""Sharding with size-tiered compaction and a versioned manifest.

``append`` writes arrivals as small immutable shards, one for each task, and commits a
manifest that adds them.  ``compact`` puts live shards into tiers by size, merges the
shards of a tier into files of about ``target_bytes`` (no row is shuffled: each output task reads
its share of the tier's files), and commits a manifest in which the outputs replace the inputs.
A manifest is a file of one JSON line for each live shard, written aside and renamed to
``manifest/v<number>`` only if no such name exists, so a commit is seen whole or not at all and of two writers one fails.
Readers take the files of one version; files of no version kept are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import delete, file_system, free, hadoop_path

CODEC = "zstd"


@dataclass(frozen=True)
class Shard:
    shard_id: int
    path: str
    bytes: int
    level: int  # merges behind it


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version first."""


class ShardStore:
    """A folder of shards and manifests, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fan_in: int = 4, factor: int = 4):
        """Tiers grow by ``factor``; a tier is merged when it has ``fan_in`` shards. Shards of half the target or more stay."""
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.fan_in, self.factor = target_bytes, fan_in, factor

    # manifests

    def versions(self) -> list[int]:
        fs, path = file_system(self.spark, self.root), hadoop_path(self.spark, f"{self.root}/manifest")
        if not fs.exists(path):
            return []
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v"))

    def manifest(self, version: int | None = None) -> list[Shard]:
        """The live shards of a version, by default the last; none before the first commit."""
        found = self.versions()
        if version is None and not found:
            return []
        version = found[-1] if version is None else version
        lines = self.spark.sparkContext.textFile(f"{self.root}/manifest/v{version:09d}", 1).collect()
        return [Shard(**json.loads(x)) for x in lines if x]

    def commit(self, shards: Iterable[Shard], version: int) -> None:
        """Makes ``shards`` the live ones as ``version``; fails if that version exists."""
        jvm, path = self.spark._jvm, hadoop_path
        aside = path(self.spark, f"{self.root}/staged/{uuid.uuid4().hex}")
        to = path(self.spark, f"{self.root}/manifest/v{version:09d}")
        fs = file_system(self.spark, self.root)
        fs.mkdirs(to.getParent())
        out = fs.create(aside, False)
        try:
            lines = [json.dumps(asdict(shard)) + "\n" for shard in shards]
            for k in range(0, len(lines), 10_000):
                out.write(bytearray("".join(lines[k : k + 10_000]).encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            rename.rename(aside, to, options)
        except Exception as e:
            fs.delete(aside, False)
            if fs.exists(to):
                raise ConcurrentCommit(f"version {version} exists") from e
            raise

    # shards

    def _written(self, df: DataFrame, folder: str) -> list[tuple[str, int]]:
        df.write.option("compression", CODEC).parquet(folder)
        fs = file_system(self.spark, folder)
        files = fs.listFiles(hadoop_path(self.spark, folder), True)
        found = []
        while files.hasNext():
            status = files.next()
            if status.getPath().getName().startswith("part-"):
                found.append((status.getPath().toString(), int(status.getLen())))
        return sorted(found)

    def append(self, df: DataFrame) -> int:
        """Writes an arrival's rows as shards, as its partitions lie, and commits them; the new version. Files without rows are shards too."""
        return self.append_all([df])

    def append_all(self, arrivals: Iterable[DataFrame]) -> int:
        version = (self.versions() or [0])[-1]
        for df in arrivals:
            live = self.manifest(version) if version else []
            first = 1 + max((s.shard_id for s in live), default=-1)
            files = self._written(df, f"{self.root}/data/{uuid.uuid4().hex}")
            version += 1
            self.commit([*live, *(Shard(first + k, p, n, 0) for k, (p, n) in enumerate(files))], version)
        return version

    def tier(self, size: int) -> int:
        n, most = 0, 1 << 16
        while size >= most:
            n, most = n + 1, most * self.factor
        return n

    def due(self, shards: list[Shard]) -> list[Shard]:
        """The shards to merge next: those of the lowest tier that has ``fan_in``; none if no tier has."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < self.target_bytes // 2:
                tiers.setdefault(self.tier(s.bytes), []).append(s)
        full = [t for t in sorted(tiers) if len(tiers[t]) >= self.fan_in]
        return tiers[full[0]] if full else []

    def compact(self) -> int:
        """Merges until no tier is due; the last version. Each merge is one commit. Rows stay as they are, repeated and null ones too; a store without shards stays at version 0."""
        version = (self.versions() or [0])[-1]
        while version and (chosen := self.due(live := self.manifest(version))):
            total = sum(s.bytes for s in chosen)
            outputs = max(1, min(len(chosen) // 2, round(total / self.target_bytes)))
            df = self.spark.read.parquet(*[s.path for s in chosen]).coalesce(outputs)
            files = self._written(df, f"{self.root}/data/{uuid.uuid4().hex}")
            gone = {s.shard_id for s in chosen}
            first, level = 1 + max(s.shard_id for s in live), 1 + max(s.level for s in chosen)
            version += 1
            self.commit([*(s for s in live if s.shard_id not in gone), *(Shard(first + k, p, n, level) for k, (p, n) in enumerate(files))], version)
        return version

    def vacuum(self, keep: int = 1) -> None:
        """Removes all but the last ``keep`` versions and the shards of none of those kept."""
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        live = {s.path for v in kept for s in self.manifest(v)}
        for path in {s.path for v in old for s in self.manifest(v)} - live:
            delete(self.spark, path)
        for v in old:
            delete(self.spark, f"{self.root}/manifest/v{v:09d}")

    def read(self, version: int | None = None, with_shard: bool = False) -> DataFrame | None:
        """The rows of a version; None where it has no shard. ``with_shard`` adds shard_id, shard_bytes and shard_level, each with underscores before it where the rows have such a column."""
        live = self.manifest(version)
        if not live:
            return None
        df = self.spark.read.parquet(*[s.path for s in live])
        if not with_shard:
            return df
        key, *own = (free(c, df) for c in ("shard_file", "shard_id", "shard_bytes", "shard_level"))
        names = self.spark.createDataFrame([(s.path.rsplit("/", 2)[-2] + "/" + s.path.rsplit("/", 1)[-1], s.shard_id, s.bytes, s.level) for s in live], "{} string, {} long, {} long, {} int".format(key, *own))
        file = F.regexp_extract(F.input_file_name(), "([^/]+/[^/]+)$", 1)
        # a small line for each shard: broadcast while they are under some 10 MB
        return df.withColumn(key, file).join(F.broadcast(names) if len(live) <= 100_000 else names, key).drop(key)


def shard(docs: DataFrame, root: str, arrivals: int = 4, part_of: Callable[[], F.Column] | None = None, **settings: int) -> ShardStore:
    """Appends ``docs`` as ``arrivals`` arrivals, compacts, drops what was merged; the store.

    Rows are kept as they are: nulls, empty and repeated texts, further columns.
    The arrivals are written in one pass over ``docs``; each commits on its own.
    A table without rows gives shards without rows. ``part_of`` gives a row's arrival (0 and up); by default by hash of all columns.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, root, **settings)
    column = part_of() if part_of else F.pmod(F.xxhash64(*docs.columns), F.lit(arrivals)).cast("int")
    staged = f"{store.root}/arrivals/{uuid.uuid4().hex}"
    name = free("arrival", docs)
    docs.withColumn(name, column).write.option("compression", CODEC).partitionBy(name).parquet(staged)
    fs = file_system(spark, staged)
    version, live = (store.versions() or [0])[-1], store.manifest()
    folders = sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path(spark, staged)) if s.isDirectory() and f"{name}=" in s.getPath().getName())
    if not folders:
        store.append(docs.limit(0))
        return store
    for folder in folders:
        files = sorted((s.getPath().toString(), int(s.getLen())) for s in fs.listStatus(hadoop_path(spark, folder)) if s.getPath().getName().startswith("part-"))
        first = 1 + max((s.shard_id for s in live), default=-1)
        live = [*live, *(Shard(first + k, p, n, 0) for k, (p, n) in enumerate(files))]
        version += 1
        store.commit(live, version)
    store.compact()
    store.vacuum()
    return store
