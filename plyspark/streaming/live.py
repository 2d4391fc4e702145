"""Streams: incremental tables by file arrival, and live match states."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import elo

OUTCOME = "run string, wins long, draws long, losses long"


def follow(spark: SparkSession, folder: str, schema: T.StructType, into: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Hands each batch of new Parquet files to ``into`` (rows, batch id); with ``once`` it ends when all are taken.

    The checkpoint says what was taken, so a restart takes no file twice; ``into`` should be idempotent by batch id.
    """
    writer = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(into).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def unseen(into: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key the table doesn't have."""
    return rows.dropDuplicates([key]).join(into.select(key), key, "left_anti")


def _tally(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    w, d, losses = state.get if state.exists else (0, 0, 0)
    for rows in batches:
        n = rows["outcome"].value_counts()
        w, d, losses = w + int(n.get("w", 0)), d + int(n.get("d", 0)), losses + int(n.get("l", 0))
    state.update((w, d, losses))
    yield pd.DataFrame({"run": [key[0]], "wins": [w], "draws": [d], "losses": [losses]})


def live_tests(games: DataFrame, elo0: float = 0.0, elo1: float = 10.0, alpha: float = 0.05, beta: float = 0.05) -> DataFrame:
    """From a stream of games (run, outcome w, d or l): each run's tally after a batch, its likelihood ratio and what that decides."""
    tallies = games.groupBy("run").applyInPandasWithState(_tally, OUTCOME, "wins long, draws long, losses long", "update", GroupStateTimeout.NoTimeout)
    llr = elo.log_likelihood_ratio(F.col("wins"), F.col("draws"), F.col("losses"), elo0, elo1)
    return tallies.withColumn("llr", llr).withColumn("decision", elo.decision(F.col("llr"), *elo.bounds(alpha, beta)))
