"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) reaches.

    Alternating star contraction: each round links every node's neighbours to
    the least of them, so a round moves rows in proportion to the edges and
    the number of rounds is logarithmic in a component's diameter.  Rounds are
    written to the shared folder; only an edge count and a checksum come to the driver.
    Nulls in either end and loops are ignored; no edges give no rows.
    """
    step = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-0")
    seen = None
    for k in count(1):
        both = step.union(step.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, "a")
            .select(F.explode(F.array(F.struct("b", F.col("m").alias("c")), F.struct(F.col("a").alias("b"), F.col("m").alias("c")))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.c").alias("b"))
            .where("a <> b")
            .distinct()
        )
        step = scratch.save(small, f"cc-{k}")
        now = step.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
        scratch.drop(f"cc-{k - 1}")
        if now == seen:
            return step.select(F.col("a").alias("node"), F.col("b").alias("component")).union(step.select(F.col("b"), F.col("b")).distinct())
        seen = now
