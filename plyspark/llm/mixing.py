"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words.  Among all document rates that meet
it, entropy balancing takes those nearest to 1 in relative entropy, at most ``cap``; they are
exp(l * size / mean) with one dual l for each source, which minimises a convex function, so a
source that gives more than it has repeats its long documents most, and one that gives less drops them first.
Newton steps for all sources run together in Spark, over counts of documents by source and size, which are made once.
Rates are then rounded into whole copies: sizes in falling order carry the
words left over to the next smaller size, and within a size the documents of
least hash get the odd copies, so equal inputs give equal copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch, whole_row

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame, scratch: Scratch, pattern: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """(source, source_size, weight): sources by code point, null last, take the weights of ``pattern`` in turn.

    The rank is a rank within a range of sources plus the sources in ranges before, so no task sees all sources.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    ranges = totals.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    ranges = scratch.save(ranges, "sources")
    # a row for each range
    before = ranges.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1 + F.col("before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in pattern]), (place % len(pattern) + 1).cast("int"))
    return ranges.join(F.broadcast(before), "part").select("source", "source_size", weight.alias("weight"))


def water_filled(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """``sources`` with ``target``: ``share`` times all sizes by weight, none above ``cap`` times its source's size.

    What a source can't take goes to the others by weight until none is above: target = min(cap * size, level * weight).
    Each round is one aggregate that returns one row.
    """
    most = F.col("source_size") * float(cap)
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level >= most
        row = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, most)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], max(level, (total - row[1]) / row[2])
    return sources.withColumn("target", F.least(most, F.col("weight") * level) if total else F.lit(0.0))


#: The dual of a source whose target takes every document ``cap`` times.
FULL = 1e12


def rate(cap: float, dual: str = "dual") -> Column:
    """Copies of a document of column ``size`` whose source has column ``mean`` and the dual."""
    return F.least(F.lit(float(cap)), F.exp(F.least(F.lit(700.0), F.col(dual) * F.col("size") / F.col("mean"))))


def newton_duals(hist: DataFrame, sources: DataFrame, scratch: Scratch, cap: float, tolerance: float = 1e-9, most_steps: int = 60) -> DataFrame:
    """(source, mean, dual): the duals at which each source's words meet its target, to ``tolerance`` of it.

    ``hist`` has (source, size, n).  A step adds up, for each source, the words that the present rates give and their
    derivative.  Words grow with the dual, so each step also narrows an interval; where Newton's step leaves it, the middle is taken.
    """
    base = hist.where("size > 0").groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"), (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    aims = sources.where("target > 0").select(F.col("source").alias("of"), "target")
    duals = base.join(aims, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    full = F.col("target") >= F.col("words") * float(cap) * (1 - tolerance)
    none = F.lit(None).cast("double")
    duals = scratch.save(duals.select("source", "mean", "target", F.when(full, FULL).otherwise(0.0).alias("dual"), none.alias("low"), none.alias("high"), full.alias("done")), "duals-0")
    for step in range(1, most_steps + 1):
        tilted = rate(cap)
        x = F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size") * tilted
        moving = F.when(tilted < cap, words * x).otherwise(0.0)
        open_ = duals.where("NOT done").withColumnRenamed("source", "of")
        sums = hist.where("size > 0").join(open_, F.col("source").eqNullSafe(F.col("of"))).groupBy("of", "mean", "target", "dual", "low", "high").agg(F.sum(words).alias("words"), F.sum(moving).alias("slope"))
        miss = F.col("target") - F.col("words")
        low, high = F.when(miss > 0, F.col("dual")).otherwise(F.col("low")), F.when(miss < 0, F.col("dual")).otherwise(F.col("high"))
        moved = sums.select("of", "mean", "target", "dual", low.alias("low"), high.alias("high"), F.when(F.col("slope") > 0, F.col("dual") + miss / F.col("slope")).alias("newton"), (F.abs(miss) <= tolerance * F.col("target")).alias("done"))
        inside = F.col("newton").isNotNull() & (F.coalesce(F.col("newton") > F.col("low"), F.lit(True))) & (F.coalesce(F.col("newton") < F.col("high"), F.lit(True)))
        middle = F.when(F.col("low").isNull(), F.col("high") - 1 - F.abs("high")).when(F.col("high").isNull(), F.col("low") + 1 + F.abs("low")).otherwise((F.col("low") + F.col("high")) / 2)
        # a long step is cut short: far from the root the exponential misleads
        newton = F.col("dual") + F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.col("newton") - F.col("dual")))
        next_ = F.when(F.col("done"), F.col("dual")).when(inside, newton).otherwise(middle)
        moved = moved.select(F.col("of").alias("source"), "mean", "target", next_.alias("dual"), "low", "high", "done")
        duals = scratch.save(moved.union(duals.where("done")), f"duals-{step}")
        left = duals.where("NOT done").limit(1).count()
        scratch.drop(f"duals-{step - 1}")
        if not left:
            break
    return duals.select("source", "mean", "dual")


def _rounded(cap: float):
    def run(hist: pd.DataFrame) -> pd.DataFrame:
        hist = hist.sort_values("size", ascending=False)
        left, copies = 0.0, []
        for size, n, rate in zip(hist["size"], hist["n"], hist["rate"], strict=True):
            want = left + n * rate * size
            k = int(min(np.floor(cap) * n, max(0, np.floor(want / size + 0.5))))
            copies.append(k)
            left = want - k * size
        return hist.assign(copies=copies)[["source", "size", "n", "copies"]]

    return run


def mix(docs: DataFrame, share: float = 1.5, pattern: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 2.0, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of ``docs`` (doc_id, text, source).

    A null text has size 0; a text without words is never taken (0 copies); a null source is a source of its own and
    the last; repeated rows are rows like others; no rows give no rows; further columns are ignored.
    Rows that agree in doc_id, source and size are told apart by nothing, so which of them
    gets an odd copy doesn't show.  ``cap`` is at least 1; a document gets at most floor(cap) copies.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col("doc_id"), F.col("source"), size_of().alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    rows = scratch.save(rows, "rows")
    hist = scratch.save(rows.groupBy("source", "size").agg(F.sum("m").alias("n")), "hist")
    sources = scratch.save(water_filled(scratch.save(ranked_sources(hist, scratch, pattern), "ranked"), share, cap), "targets")
    duals = newton_duals(hist, sources, scratch, cap).withColumnRenamed("source", "of")
    rated = hist.where("size > 0").join(duals, F.col("source").eqNullSafe(F.col("of"))).select("source", "size", "n", rate(cap).alias("rate"))
    # a group has a row for each distinct size of a source, which the longest text bounds
    classes = rated.groupBy("source").applyInPandas(_rounded(cap), "source string, size long, n long, copies long")
    return _dealt(rows, scratch.save(classes, "classes"), sources, scratch)


def _dealt(rows: DataFrame, classes: DataFrame, sources: DataFrame, scratch: Scratch, bucket: int = 512) -> DataFrame:
    """Copies to documents: floor(copies / n) each and one more for those of least hash in their class of a source and a size.

    ``rows`` has equal rows once, with their number m. Large classes are ranked in buckets of about ``bucket`` rows, by hash, so that no
    task ranks a whole class; rows of no class (without words, or of a source that gives nothing) aren't ranked.
    """
    c = classes.select(F.col("source").alias("of"), F.col("size").alias("z"), "n", "copies")
    key = F.xxhash64("doc_id")
    spread = rows.join(c, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("z")), "left").withColumn("key", key)
    spread = spread.withColumn("bucket", F.expr(f"CASE WHEN n > {bucket} THEN shiftrightunsigned(key, 33) * ceil(n / {bucket}) div 2147483648 ELSE 0 END"))
    counted = scratch.save(spread, "spread")
    large = counted.where(F.col("n") > bucket).groupBy("of", "z", "bucket").agg(F.sum("m").alias("k"))
    before = large.withColumn("before", F.sum("k").over(Window.partitionBy("of", "z").orderBy("bucket")) - F.col("k")).select(F.col("of").alias("o2"), F.col("z").alias("z2"), F.col("bucket").alias("b2"), "before")
    order = Window.partitionBy("source", "size", "bucket").orderBy(F.shiftrightunsigned("key", 33), "key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.where("n IS NOT NULL").withColumn("place", F.sum("m").over(order) - F.col("m"))
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("o2")) & (F.col("size") == F.col("z2")) & (F.col("bucket") == F.col("b2")), "left")
    odd = F.expr("greatest(0L, least(m, copies % n - place - coalesce(before, 0L)))")
    taken = placed.select("doc_id", "source", "size", "m", F.expr("copies div n").alias("each"), odd.alias("odd"))
    none = counted.where("n IS NULL").select("doc_id", "source", "size", "m", F.lit(0).cast("long").alias("each"), F.lit(0).cast("long").alias("odd"))
    every = taken.union(none).withColumn("at", F.explode(F.expr("sequence(1L, m)"))).withColumn("taken", F.expr("each + CASE WHEN at <= odd THEN 1L ELSE 0L END"))
    t = sources.select(F.col("source").alias("s2"), "source_size", "target")
    return every.join(t, F.col("source").eqNullSafe(F.col("s2"))).select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), F.col("taken").alias("copies"))


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed``, the result of ``mix`` on them, takes it.

    Rows that agree in doc_id, source and size share their copies evenly, equal rows as one
    row with a count, so a row that is repeated without end is never gathered. All columns of ``docs`` come back as they are.
    """
    keys = mixed.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"), F.sum("copies").alias("total"))
    keys = keys.where("total > 0").select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), "m", "total")
    own = docs.select(whole_row(docs), size_of().alias("size"))
    joined = own.join(keys, F.col("row.doc_id").eqNullSafe(F.col("d")) & F.col("row.source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    single = joined.where("m = 1").select("row", F.col("total").alias("k"))
    several = joined.where("m > 1").groupBy("row", "d", "s", "z", "m", "total").agg(F.count("*").alias("c"))
    several = several.withColumn("before", F.sum("c").over(Window.partitionBy("d", "s", "z").orderBy("row")) - F.col("c"))
    share = F.expr("c * (total div m) + greatest(0L, least(c, total % m - before))")
    rows = single.union(several.select("row", share.alias("k"))).where("k > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k")))).select("row.*")
