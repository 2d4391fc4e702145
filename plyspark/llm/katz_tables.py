"""Katz models of any order as stored tables, for corpora that the model isn't made with.

``fit`` writes, for each order, a table of n-grams (h, w, n, p): the hash of the words before, the word, its count and discounted
probability; and a table of backoff weights (h, weight).  ``score`` evaluates the recursion by joins: a token's probability of
an order is that of its n-gram where it was seen, and else the weight of the words before times the probability of the order below;
where those words were never seen it is the probability below itself.  Weights are exact: after any words, all words and the unknown ones
sum to one.  Tokens are words and ends as in ``katz``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .katz import RELIABLE, REST, START, _tokens, discounts
from .runtime import Scratch
from .text import fold, steps


@dataclass
class Tables:
    """A stored model: where its tables are, its order, and the probability of the class of unknown words."""

    scratch: Scratch
    order: int
    unknown: float

    def grams(self, k: int) -> DataFrame:
        return self.scratch.spark.read.parquet(self.scratch.path(f"grams-{k}"))

    def backoff(self, k: int) -> DataFrame:
        return self.scratch.spark.read.parquet(self.scratch.path(f"backoff-{k}"))


def contexts(docs: DataFrame, order: int) -> DataFrame:
    """(rid, w, h1, h2, ...): every token of ``docs`` (rid, text) and the hashes of one, two, ... words before it."""
    names = ["w", *[f"h{k}" for k in range(1, order)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                w, before, of = _tokens(part.column("text"))
                first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
                hashes, word = [before], before
                for _ in range(2, order):
                    word = np.concatenate((word[:1], word[:-1]))
                    word[first] = START
                    hashes.append(fold(word, hashes[-1]))
                columns = [w, *hashes[: order - 1]]
                yield pa.RecordBatch.from_arrays([part.column("rid").take(pa.array(of)), *[pa.array(c.view(np.int64)) for c in columns]], names=["rid", *names])

    return docs.select("rid", "text").mapInArrow(run, ", ".join(["rid long", *[f"{n} long" for n in names]]))


def _discounted(n: Column, d: list[float]) -> Column:
    out = n - REST
    for r in range(RELIABLE, 0, -1):
        out = F.when(n == r, F.lit(d[r] * r)).otherwise(out)
    return out


def fit(docs: DataFrame, scratch: Scratch, order: int = 3) -> Tables:
    """The model of all rows of ``docs`` (text), stored in ``scratch``.

    Null and empty texts are an end alone; repeated rows count as often; further columns are ignored; no rows give a model that
    knows nothing, in which every token has probability one.
    """
    rows = contexts(docs.select(F.lit(0).cast("long").alias("rid"), "text"), order)
    unknown, below = 1.0, None
    for k in range(1, order + 1):
        # the words before, and the words before but the first, which the order below goes by
        h = F.lit(0).cast("long") if k == 1 else F.col(f"h{k - 1}")
        shorter = F.lit(0).cast("long") if k <= 2 else F.col(f"h{k - 2}")
        counts = scratch.save(rows.select(h.alias("h"), shorter.alias("shorter"), "w").groupBy("h", "w").agg(F.first("shorter").alias("shorter"), F.count("*").alias("n")), f"counts-{k}")
        few = counts.agg(*[F.count_if(F.col("n") == r) for r in range(1, RELIABLE + 2)]).first()
        total = counts.groupBy("h").agg(F.sum("n").alias("total"))
        grams = counts.join(total, "h").withColumn("p", _discounted(F.col("n"), discounts(list(few))) / F.col("total"))
        if k == 1:
            below = scratch.save(grams.select("h", "w", "n", "p"), "grams-1")
            seen = below.agg(F.sum("p")).first()[0]
            unknown = 1.0 if seen is None else 1 - seen
            continue
        # what is left after h, over the probability below of words not seen after it
        with_below = grams.join(below.select(F.col("h").alias("shorter"), "w", F.col("p").alias("lower")), ["shorter", "w"])
        left = with_below.groupBy("h").agg((F.greatest(1 - F.sum("p"), F.lit(0.0)) / F.greatest(1 - F.sum("lower"), F.lit(1e-12))).alias("weight"))
        below = scratch.save(grams.select("h", "w", "n", "p"), f"grams-{k}")
        scratch.save(left, f"backoff-{k}")
        scratch.drop(f"counts-{k}")
    scratch.drop("counts-1")
    return Tables(scratch, order, unknown)


def probabilities(tokens: DataFrame, model: Tables) -> DataFrame:
    """``tokens`` (w, h1, ...; as many as the model's order) with column ``p``, by joins from the lowest order up. Common words are skewed keys; adaptive execution splits them."""
    out = tokens.join(model.grams(1).select("w", F.col("p").alias("p_seen")), "w", "left").withColumn("p", F.coalesce("p_seen", F.lit(model.unknown))).drop("p_seen")
    for k in range(2, model.order + 1):
        h = f"h{k - 1}"
        grams, weights = model.grams(k).select(F.col("h").alias(h), "w", F.col("p").alias("p_seen")), model.backoff(k).withColumnRenamed("h", h)
        out = out.join(grams, [h, "w"], "left").join(weights, h, "left")
        out = out.withColumn("p", F.coalesce("p_seen", F.col("weight") * F.col("p"), "p")).drop("p_seen", "weight")
    return out


def score(docs: DataFrame, model: Tables) -> DataFrame:
    """(rid, score) of each row of ``docs`` (rid long, text): log10 of the text's probability; rows of one rid are added up, null texts are an end alone."""
    return probabilities(contexts(docs, model.order), model).groupBy("rid").agg(F.sum(F.log10(F.greatest("p", F.lit(1e-300)))).alias("score"))
