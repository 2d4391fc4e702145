"""Tables in versions that hold all of them: what a load writes is seen whole or not at all.

A version is one small file, ``_versions/v<number>``, that says of each table its schema, its keys and its parts. A part
is a folder that one write made and nothing changes; where rows of a part were replaced, the version lists which of its files
are left. A commit writes the next version aside and renames it to its number only if no such name exists, so of two writers
one fails and readers stay on the version that they opened. (Stores without such a rename need a table of versions instead.)

Of tables with keys each part has an index by file: the range of the first key, and a Bloom filter of whole keys in
bitmaps of 32,768 bits. Looking for keys opens only files that can hold one of them, and a merge replaces only those that do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a Bloom filter for each row, and of one bitmap.
BITS_A_ROW, BITMAP = 16, 32_768
#: Files of fewer rows have no Bloom filter: reading them costs no more.
SMALL = 4_096
#: Parts of the first key's span that ranges of files are compared in.
BINS = 4_096


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version first."""


@dataclass(frozen=True)
class Part:
    """A folder of files below the store; those that are left, None for all."""

    path: str
    files: tuple[str, ...] | None = None
    #: Whether some of its files have Bloom filters.
    filtered: bool = False


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    keys: tuple[str, ...] = ()
    parts: tuple[Part, ...] = ()
    #: Of each table that this one was made from, the parts that are in it.
    taken: dict[str, list[str]] = field(default_factory=dict)


def _bit(name: str, h: str) -> Column:
    """Whether the bitmap ``name`` has the bit of hash ``h``."""
    at = f"pmod(shiftrightunsigned({h}, 20), {BITMAP})"
    return F.expr(f"shiftright(CAST(conv(hex(substring({name}, CAST({at} div 8 + 1 AS INT), 1)), 16, 10) AS INT), CAST({at} % 8 AS INT)) & 1 = 1")


def _hashes(keys: Iterable[str]) -> list[Column]:
    return [F.xxhash64(F.lit(n), *[F.col(f"`{k}`") for k in keys]) for n in (1, 2)]


class View:
    """The tables of one version."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], version: int):
        self.spark, self.root, self._tables, self.version = spark, root, tables, version

    def tables(self) -> list[str]:
        return sorted(self._tables)

    def exists(self, table: str) -> bool:
        return table in self._tables

    def columns(self, table: str) -> list[str]:
        return self._tables[table].schema.names if self.exists(table) else []

    def parts(self, table: str) -> list[str]:
        """Paths of a table's parts that are whole, for what is made from them to remember."""
        return [p.path for p in self._tables[table].parts if p.files is None] if self.exists(table) else []

    def read(self, table: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or only some of its ``parts``. Columns that a part lacks are NULL there."""
        found = self._tables[table]
        chosen = found.parts if parts is None else [p for p in found.parts if p.path in set(parts)]
        paths = [f"{self.root}/{p.path}{f}" for p in chosen for f in ([""] if p.files is None else [f"/{x}" for x in p.files])]
        return self.spark.read.schema(found.schema).parquet(*paths) if paths else self.spark.createDataFrame([], found.schema)

    def added(self, table: str, taken: dict[str, list[str]], source: str | None = None) -> DataFrame | None:
        """Rows of a table's parts that ``taken`` doesn't list under ``source``; None if what it lists isn't all there any more."""
        before, now = taken.get(source or table), self._tables[table].parts
        if before is None or any(p.files is not None for p in now) or not set(before) <= {p.path for p in now}:
            return None
        return self.read(table, [p.path for p in now if p.path not in set(before)])

    def taken(self, table: str) -> dict[str, list[str]]:
        return self._tables[table].taken if self.exists(table) else {}

    def last_id(self, table: str, key: str = "id") -> int:
        """The largest id, 0 without table or rows; from the index where ``key`` is the table's first."""
        if not self.exists(table):
            return 0
        ranges = self._ranges(table) if self._tables[table].keys[:1] == (key,) else None
        return ((self.read(table).agg(F.max(key)) if ranges is None else ranges.agg(F.max("high"))).first()[0]) or 0

    # the index of keys

    def _ranges(self, table: str) -> DataFrame | None:
        """(part, file, rows, low, high, slots) of a table's files; None without an index, or where the first key is no number."""
        found = self._tables[table]
        if not found.keys or not isinstance(found.schema[found.keys[0]].dataType, T.IntegralType):
            return None
        rows = [self.spark.read.parquet(f"{self.root}/{p.path}-files") for p in found.parts]
        if not rows:
            return None
        gone = [(p.path, f) for p in found.parts if p.files is not None for f in p.files]
        cut = [p.path for p in found.parts if p.files is not None]
        every = reduce(DataFrame.unionAll, rows)
        if not cut:
            return every
        left = self.spark.createDataFrame(gone, "part string, file string")
        return every.where(~F.col("part").isin(cut)).unionAll(every.where(F.col("part").isin(cut)).join(left, ["part", "file"], "left_semi"))

    def holding(self, table: str, wanted: DataFrame) -> list[tuple[str, str]] | None:
        """(part, file) of files that can hold a key of ``wanted``; None if there is no index to tell."""
        keys = self._tables[table].keys
        ranges = self._ranges(table)
        if ranges is None:
            return None
        low, high = ranges.agg(F.min("low"), F.max("high")).first()
        if low is None:
            return []
        step = (high - low) // BINS + 1
        of = lambda c: F.floor((F.col(c) - F.lit(low)) / F.lit(step)).cast("long")
        first, second = _hashes(keys)
        asked = wanted.select(*keys).distinct().select(F.col(keys[0]).alias("key"), of(keys[0]).alias("bin"), first.alias("h1"), second.alias("h2"))
        files = ranges.where("low IS NOT NULL").withColumn("bin", F.explode(F.sequence(of("low"), of("high"))))
        near = asked.join(files, "bin").where("key BETWEEN low AND high").select("part", "file", "slots", "h1", "h2")
        bits = [self.spark.read.parquet(f"{self.root}/{p.path}-bits") for p in self._tables[table].parts if p.filtered]
        sure = near.where("slots = 0")
        if bits:
            every, near = reduce(DataFrame.unionAll, bits), near.where("slots > 0")
            for h in ("h1", "h2"):
                near = near.withColumn("slot", F.expr(f"pmod({h}, slots)")).join(every, ["part", "file", "slot"]).where(_bit("bits", h)).drop("slot", "bits")
            sure = sure.select("part", "file").unionAll(near.select("part", "file"))
        return [tuple(r) for r in sure.select("part", "file").distinct().collect()]

    def _files(self, table: str, files: list[tuple[str, str]]) -> DataFrame:
        schema = self._tables[table].schema
        paths = [f"{self.root}/{part}/{file}" for part, file in files]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def missing(self, table: str, rows: DataFrame, keys: dict[str, str] | None = None) -> DataFrame:
        """Those of ``rows`` whose whole key the table doesn't hold (a key with a NULL is never held). ``keys``: names of key columns in ``rows`` where they differ."""
        own = self._tables[table].keys
        name = {k: (keys or {}).get(k, k) for k in own}
        files = self.holding(table, rows.select(*[F.col(name[k]).alias(k) for k in own]))
        held = self.read(table) if files is None else self._files(table, files)
        return rows.join(held.select(*[F.col(k).alias(name[k]) for k in own]), list(name.values()), "left_anti")


class Store(View):
    """A folder of tables. Each writing method is a commit; ``begin`` puts several into one."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, tuple[str, ...]] | None = None):
        """``keys``: key columns of tables by name, the first a number where files shall be found by it."""
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys or {}

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/_versions")
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v")) if fs.exists(p) else []

    @property
    def version(self) -> int:
        return (self.versions() or [0])[-1]

    def at(self, version: int) -> View:
        """The tables as of a version, whatever is committed later."""
        if version == 0:
            return View(self.spark, self.root, {}, 0)
        (content,) = (r.value for r in self.spark.read.text(f"{self.root}/_versions/v{version:09d}", wholetext=True).collect())
        tables = {
            name: Table(T.StructType.fromJson(t["schema"]), tuple(t["keys"]), tuple(Part(p["path"], None if p["files"] is None else tuple(p["files"]), p["filtered"]) for p in t["parts"]), t["taken"])
            for name, t in json.loads(content).items()
        }
        return View(self.spark, self.root, tables, version)

    @property
    def _tables(self) -> dict[str, Table]:
        return self.at(self.version)._tables

    def begin(self) -> Commit:
        return Commit(self)

    def write(self, table: str, df: DataFrame) -> None:
        """Replaces a table, also by what is derived from it."""
        with self.begin() as commit:
            commit.write(table, df)

    def append(self, table: str, df: DataFrame) -> None:
        with self.begin() as commit:
            commit.append(table, df)

    def merge(self, table: str, changes: DataFrame, add: tuple[str, ...] = ()) -> int:
        with self.begin() as commit:
            return commit.merge(table, changes, add)

    def drop(self, *tables: str) -> None:
        with self.begin() as commit:
            commit.drop(*tables)

    def clear(self, keep_engines: bool = False) -> None:
        self.drop(*[t for t in self.tables() if not (keep_engines and t == "engines")])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the last ``keep`` versions, and folders that none of these has, also those of writers that failed; the folders removed.

        Not to be called while another writer is at work: what it has written isn't in a version yet.
        """
        kept = self.versions()[-keep:] if keep else []
        used = {p.path for v in kept for t in self.at(v)._tables.values() for p in t.parts}
        fs, top = self._fs(self.root)
        removed = []
        for folder in (s.getPath() for s in fs.listStatus(top) if s.isDirectory() and not s.getPath().getName().startswith("_")):
            for part in (s.getPath() for s in fs.listStatus(folder)):
                name = f"{folder.getName()}/{part.getName()}"
                if name.removesuffix("-files").removesuffix("-bits") not in used:
                    fs.delete(part, True)
                    removed.append(name)
        for v in self.versions():
            if v not in kept:
                fs.delete(self._fs(f"{self.root}/_versions/v{v:09d}")[1], False)
        return sorted(removed)


class Commit(View):
    """Writes that become one version when the block ends, and none if it fails. Reads within it see its own writes."""

    def __init__(self, store: Store):
        base = store.at(store.version)
        super().__init__(store.spark, store.root, dict(base._tables), base.version)
        self.store, self._base = store, base._tables

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None and self._tables != self._base:
            self._publish()

    def _publish(self) -> None:
        fs, aside = self.store._fs(f"{self.root}/_versions/_{uuid.uuid4().hex}")
        to = self.store._fs(f"{self.root}/_versions/v{self.version + 1:09d}")[1]
        content = {n: {"schema": t.schema.jsonValue(), "keys": t.keys, "parts": [{"path": p.path, "files": p.files, "filtered": p.filtered} for p in t.parts], "taken": t.taken} for n, t in self._tables.items()}
        fs.mkdirs(to.getParent())
        out = fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(aside, to, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(aside, False)
            if fs.exists(to):
                raise ConcurrentCommit(f"version {self.version + 1} exists") from e
            raise

    def _written(self, table: str, df: DataFrame, keys: tuple[str, ...]) -> Part:
        """``df`` as a new part, in ranges of its first key, and its index."""
        part = f"{table}/{uuid.uuid4().hex[:12]}"
        if keys:
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.parquet(f"{self.root}/{part}")
        if keys and isinstance(df.schema[keys[0]].dataType, T.IntegralType):
            first, second = _hashes(keys)
            rows = self.spark.read.schema(df.schema).parquet(f"{self.root}/{part}").select(F.lit(part).alias("part"), F.col("_metadata.file_name").alias("file"), F.col(keys[0]).cast("long").alias("key"), first.alias("h1"), second.alias("h2"))
            size = F.count("*").alias("rows")
            slots = F.when(F.count("*") >= SMALL, F.ceil(F.count("*") * BITS_A_ROW / BITMAP)).otherwise(0).alias("slots")
            rows.groupBy("part", "file").agg(size, F.min("key").alias("low"), F.max("key").alias("high"), slots).write.parquet(f"{self.root}/{part}-files")
            files = self.spark.read.parquet(f"{self.root}/{part}-files").where("slots > 0").select("file", "slots")
            if not files.isEmpty():
                marks = rows.join(files, "file").select("part", "file", "slots", F.explode(F.array("h1", "h2")).alias("h"))
                at = F.expr(f"pmod(shiftrightunsigned(h, 20), {BITMAP})")
                bits = marks.groupBy("part", "file", F.expr("pmod(h, slots)").alias("slot")).agg(F.bitmap_construct_agg(at).alias("bits"))
                bits.write.parquet(f"{self.root}/{part}-bits")
                return Part(part, filtered=True)
        return Part(part)

    def write(self, table: str, df: DataFrame, taken: dict[str, list[str]] | None = None) -> None:
        keys = tuple(self.store.keys.get(table, ()))
        self._tables[table] = Table(_nullable(df.schema), keys, (self._written(table, df, keys),), taken or {})

    def append(self, table: str, df: DataFrame, taken: dict[str, list[str]] | None = None) -> None:
        """Adds a part. Columns that either side lacks are NULL there; new ones come last."""
        if not self.exists(table):
            return self.write(table, df, taken)
        have = self._tables[table]
        fitted = _fitted(df, have.schema)
        schema = T.StructType([*have.schema, *_nullable(fitted.schema)[len(have.schema) :]])
        part = self._written(table, fitted, have.keys)
        self._tables[table] = Table(schema, have.keys, (*have.parts, part), have.taken if taken is None else taken)

    def merge(self, table: str, changes: DataFrame, add: tuple[str, ...] = (), taken: dict[str, list[str]] | None = None) -> int:
        """Upserts ``changes`` by the table's keys (see ``upsert``); how many files were replaced, which are those that hold a key of theirs."""
        have = self._tables[table]
        if not have.keys:
            raise ValueError(f"{table} has no keys to merge by")
        keys = list(have.keys)
        files = self.holding(table, changes)
        hit: set[tuple[str, str]] = set()
        if files != [] and have.parts:
            old = self.read(table) if files is None else self._files(table, files)
            place = (F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+)/[^/]+$", 1).alias("_part"), F.col("_metadata.file_name").alias("_file"))
            hit = {tuple(r) for r in old.select(*keys, *place).join(changes.select(*keys).distinct(), keys, "left_semi").select("_part", "_file").distinct().collect()}
        parts = tuple(self._without(p, {f for part, f in hit if part == p.path}) for p in have.parts)
        merged = upsert(self._files(table, sorted(hit)), _fitted(changes, have.schema, extra=False), keys, add)
        part = self._written(table, merged, have.keys)
        self._tables[table] = Table(have.schema, have.keys, (*[p for p in parts if p.files != ()], part), have.taken if taken is None else taken)
        return len(hit)

    def _without(self, part: Part, files: set[str]) -> Part:
        if not files:
            return part
        have = part.files
        if have is None:
            fs, folder = self.store._fs(f"{self.root}/{part.path}")
            have = tuple(sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")))
        return Part(part.path, tuple(f for f in have if f not in files), part.filtered)

    def drop(self, *tables: str) -> None:
        for t in tables:
            self._tables.pop(t, None)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _fitted(df: DataFrame, schema: T.StructType, extra: bool = True) -> DataFrame:
    """``df`` with the columns of ``schema`` in its types; NULL where it lacks one; ``extra``: its further columns after them."""
    own = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*own, *[F.col(f"`{c}`") for c in df.columns if extra and c not in schema.names])


def upsert(old: DataFrame, new: DataFrame, key: str | list[str], add: tuple[str, ...] = ()) -> DataFrame:
    """``old`` with the values of ``new`` that aren't NULL; columns in ``add`` are added up; keys of ``new`` alone come in."""
    o, n = old.alias("o"), new.alias("n")
    keys = [key] if isinstance(key, str) else key
    joined = o.join(n, reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]), "full")

    def merged(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c in add:
            both = F.coalesce(f"o.{c}", F.lit(0)) + F.coalesce(f"n.{c}", F.lit(0))
            return F.when(F.col(f"o.{c}").isNotNull() | F.col(f"n.{c}").isNotNull(), both)
        return F.coalesce(f"n.{c}", f"o.{c}")

    return joined.select(*[merged(c).alias(c) for c in old.columns])
