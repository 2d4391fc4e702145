"""Ranks and running totals over a whole table, without a task that sees all rows.

Rows are dealt by ranges of the order and saved, so that what is read again has the same ranges; what the
ranges before hold is added from a table of one row for each range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import free, saved

#: ``monotonically_increasing_id`` has the partition above these bits and the row's place below.
PLACE_BITS = 33


def _with_before(ranges: DataFrame, at: str, value: F.Column, name: str) -> DataFrame:
    """``ranges`` with column ``name``: the sum of ``value`` over all ranges with a lower number ``at``."""
    key = free("_before_of", ranges)
    sums = ranges.groupBy(F.col(at).alias(key)).agg(F.sum(value).alias("sum"))
    before = sums.select(key, (F.sum("sum").over(Window.orderBy(key)) - F.col("sum")).alias(name))  # a row for each range
    return ranges.join(F.broadcast(before), F.col(at) == F.col(key)).drop(key)


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to each, by ``order``, which has no ties."""
    at, within, before = (free(c, df) for c in ("_range", "_within", "_before"))
    upto = F.sum(value).over(Window.partitionBy(at).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ranges = saved(df.repartitionByRange(*order).withColumn(at, F.spark_partition_id()).withColumn(within, upto), "ranges")
    total = _with_before(ranges, at, F.col(value), before)
    return total.withColumn(name, F.col(before) + F.col(within)).drop(at, within, before)


def ranked(df: DataFrame, order: list[str], start: int = 0, name: str = "id") -> DataFrame:
    """``df`` with dense numbers from ``start`` + 1 by ``order``, which has no ties. One shuffle, by ranges."""
    at, place, before = (free(c, df) for c in ("_range", "_place", "_before"))
    rows = saved(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn(at, F.shiftright(place, PLACE_BITS))
    total = _with_before(rows, at, F.lit(1).cast("long"), before)
    rank = F.col(before) + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1 + start
    return total.withColumn(name, rank).drop(at, place, before)
