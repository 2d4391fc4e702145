"""Checks by key: orphans of several children, duplicates and rules in one shuffle."""

import random

from pyspark.sql import functions as F

from plyspark.operators import quality
from plyspark.operators.quality import Source


def lost(child, parents):
    if None in parents:
        return 0
    return len(child) if not parents else sum(k is not None and k not in parents for k in child)


def test_children_of_several_parents_by_hand(spark):
    rng = random.Random(3)
    some = lambda n, most, null: [None if rng.random() < null else rng.randrange(most) for _ in range(n)]
    frame = lambda keys, names="id long": spark.createDataFrame([k if isinstance(k, tuple) else (k,) for k in keys], names)
    for nulls in (0.0, 0.2):
        for parents_of_one in (some(20, 40, 0.0), [], some(5, 30, 0.6)):
            games, turns, notes = parents_of_one, list(zip(some(60, 50, 0.0), some(60, 50, nulls), strict=True)), some(80, 90, nulls)
            sources = [
                Source(frame(games), parent=("game", "id")),
                Source(frame(turns, "id long, game long"), parent=("turn", "id"), children={"A": ("game", "game")}, duplicates={"D": ["id", "game"]}, rules={"R": F.col("game") > 20}),
                Source(frame(notes, "turn long"), children={"B": ("turn", "turn"), "C": ("game", "turn")}, rules={"S": F.col("turn") < 3, "T": F.col("turn").isNull()}),
            ]
            found = {r.code: r.n for r in quality.counted(sources).collect()}
            whole = [t for t in turns if t[1] is not None]
            want = {"A": lost([g for _, g in turns], games), "B": lost(notes, [t for t, _ in turns]), "C": lost(notes, games)}
            want |= {"D": len(turns) - len(set(whole)), "R": sum(g is not None and g > 20 for _, g in turns)}
            want |= {"S": sum(k is not None and k < 3 for k in notes), "T": notes.count(None)}
            assert found == want


def test_all_checks_take_one_shuffle_by_key(spark):
    parents, child = spark.range(50), spark.range(80).withColumnRenamed("id", "k")
    plan = quality.counted([Source(parents, parent=("p", "id")), Source(child, children={"A": ("p", "k")}, duplicates={"D": ["k"]}, rules={"R": F.col("k") > 3})])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert {r.code: r.n for r in plan.collect()} == {"A": 30, "D": 0, "R": 76}


def test_no_rows_anywhere(spark):
    none = spark.range(0)
    assert {r.code: r.n for r in quality.counted([Source(none, parent=("p", "id"), duplicates={"D": ["id"]}), Source(none, children={"A": ("p", "id")}, rules={"R": F.col("id") > 0})]).collect()} == {"A": 0, "D": 0, "R": 0}
