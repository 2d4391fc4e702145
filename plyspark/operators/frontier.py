"""Counts of move sequences by frontiers of positions.

A frontier has each position that so many moves lead to once, with the number of ways there. A ply is one pass over
its positions and one shuffle, in which the ways to equal positions add up, so the work follows distinct positions, not sequences.
Frontiers are written to the shared folder one after another; a ply's tasks are as many as its positions ask for.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..chesscore.rules import Position
from ..scratch import removed, shared_folder

#: Positions that a task expands, about a second's work; and rows of a batch.
TASK_POSITIONS, BATCH = 1_000, 10_000
FRONTIER = "root string, left int, state string, ways long"


def _begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for root, fen, depth in zip(*(batch.column(c).to_pylist() for c in ("root", "fen", "depth")), strict=True):
            try:
                rows.append((root, depth, Position(fen).key(), 1))
            except (ValueError, IndexError):
                continue
        yield _batch(rows)


def _batch(rows: list[tuple[str, int, str | None, int]]) -> pa.RecordBatch:
    root, left, state, ways = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(root, pa.string()), pa.array(left, pa.int32()), pa.array(state, pa.string()), pa.array(ways, pa.int64())], ["root", "left", "state", "ways"])


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The positions one move on; of those with one move left, only how many sequences end there (``state`` NULL)."""
    for batch in batches:
        rows = []
        for root, left, state, ways in zip(*(batch.column(c).to_pylist() for c in ("root", "left", "state", "ways")), strict=True):
            p = Position.of_key(state)
            moves = p.legal_moves()
            if left == 1:
                rows.append((root, 0, None, ways * len(moves)))
            else:
                rows += [(root, left - 1, key, ways * n) for key, n in Counter(p.play(m).key() for m in moves).items()]
            if len(rows) >= BATCH:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def perft(positions: DataFrame) -> DataFrame:
    """``positions`` (fen, depth, any others) with ``nodes``, the number of sequences of ``depth`` legal moves.

    1 for a depth of 0 or less; NULL where FEN or depth is, or the FEN isn't a position. Equal (fen, depth) are counted once.
    """
    spark, path = positions.sparkSession, shared_folder(positions.sparkSession, "perft")
    key = F.concat_ws(" ", F.col("depth").cast("string"), "fen")
    asked = positions.where("fen IS NOT NULL AND depth IS NOT NULL").select(key.alias("root"), "fen", F.col("depth").cast("int").alias("depth")).distinct()
    asked.mapInArrow(_begun, FRONTIER).write.parquet(f"{path}/0")
    done, k = [spark.read.parquet(f"{path}/0").where("left <= 0").select("root", F.lit(1).cast("long").alias("ways"))], 0
    while True:
        live = spark.read.schema(FRONTIER).parquet(f"{path}/{k}").where("left > 0")
        n = live.count()
        if not n:
            break
        tasks = max(spark.sparkContext.defaultParallelism, n // TASK_POSITIONS)
        grown = live.repartition(tasks, "root", "left", "state").mapInArrow(_expanded, FRONTIER)
        grown.groupBy("root", "left", "state").agg(F.sum("ways").alias("ways")).write.parquet(f"{path}/{k + 1}")
        after = spark.read.schema(FRONTIER).parquet(f"{path}/{k + 1}")
        after.where("left = 0").select("root", "ways").write.parquet(f"{path}/ended-{k}")
        done.append(spark.read.schema("root string, ways long").parquet(f"{path}/ended-{k}"))
        if k:
            removed(spark, f"{path}/{k}")
        k += 1
    ended = done[0]
    for d in done[1:]:
        ended = ended.unionAll(d)
    counts = ended.groupBy("root").agg(F.sum("ways").alias("nodes"))
    named = positions.withColumn("_root", F.when(F.col("fen").isNotNull() & F.col("depth").isNotNull(), key))
    return named.join(counts, F.col("_root") == F.col("root"), "left").select(*positions.columns, "nodes")
