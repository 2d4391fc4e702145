"""Tables stored in buckets of one key, so that joins and windows by it need no exchange.

``bucketed`` writes a table hashed into a number of buckets by the key and sorted within, and enters it in the session's catalog, since only
catalog tables tell Spark of their buckets; ``reopened`` enters files that an earlier session wrote. Tables of one key and number of buckets are
joined bucket by bucket: a task reads the same bucket of each.

A key that holds a third of the rows makes one large bucket, as it would make one large partition of a shuffle; sorted input is merged without
being held in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.search import iteration_features, wide_features
from ..scratch import shared_folder

#: Parquet bytes that a bucket should have about.
BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class Layout:
    """A bucketed table: where it is, its schema, and how its rows are dealt."""

    path: str
    schema: T.StructType
    key: str
    order: tuple[str, ...]
    buckets: int


def buckets_for(total_bytes: int, least: int = 8) -> int:
    """A power of two of buckets, so that tables of other sizes can have a divisor of it."""
    return max(least, 1 << max(0, -(-total_bytes // BUCKET_BYTES) - 1).bit_length())


def bucketed(df: DataFrame, root: str, key: str, buckets: int, order: tuple[str, ...] = ()) -> Layout:
    """Stores ``df`` in ``buckets`` by ``key``, sorted by key and ``order``: one file for each bucket, from one shuffle."""
    path, name = f"{root}/{uuid.uuid4().hex[:12]}", f"_layout_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key, *order).option("path", path).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
    return Layout(path, df.schema, key, order, buckets)


def opened(spark: SparkSession, layout: Layout) -> DataFrame:
    """The table, known to the session's catalog under a name of its own; dropping that name leaves the files."""
    name = f"_layout_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema)
    order = ", ".join(f"`{c}`" for c in (layout.key, *layout.order))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout.key}`) SORTED BY ({order}) INTO {layout.buckets} BUCKETS LOCATION '{layout.path}'")
    return spark.table(name)


@contextmanager
def by_bucket(spark: SparkSession) -> Iterator[None]:
    """Within it, sort orders of buckets of one file count in plans, and bucketed scans stay bucketed."""
    wanted = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Tables of searches and their children: the key of each, and what its rows are sorted by within.
SEARCH_KEYS = {"searches": ("id", ()), "iterations": ("search_id", ("depth",)), "timings": ("search_id", ("function",)), "positions": ("search_id", ())}


def search_layout(tables: dict[str, DataFrame], root: str, buckets: int) -> dict[str, Layout]:
    """Searches and their children in the same buckets."""
    return {name: bucketed(tables[name], root, key, buckets, order) for name, (key, order) in SEARCH_KEYS.items()}


def wide_by_bucket(spark: SparkSession, layouts: dict[str, Layout], engines: DataFrame, games: DataFrame, suites: DataFrame) -> DataFrame:
    """``wide_features`` over stored buckets: no exchange by search."""
    of = {name: opened(spark, layout) for name, layout in layouts.items()}
    return wide_features(of["searches"], iteration_features(of["iterations"]), of["timings"], of["positions"], engines, games, suites)
