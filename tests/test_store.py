"""Versions of all tables, merges that replace only the files they touch, keys looked up by range and Bloom filter."""

import os
import random

import pytest
from pyspark.sql import functions as F

from plyspark.plans import store as versions
from plyspark.plans import warehouse
from plyspark.plans.store import ConcurrentCommit, Store

KEYS = {"t": ("id", "name"), "words": ("word",)}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def numbered(spark, ids, **columns):
    return spark.createDataFrame([(k, f"n{k % 3}", 10 * k) for k in ids], "id long, name string, v long").withColumns({n: F.lit(x) for n, x in columns.items()})


def test_a_failing_load_shows_none_of_it(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write("a", spark.range(3))
    before = store.at(store.version)
    with pytest.raises(RuntimeError), store.begin() as commit:
        for k in range(5):
            commit.append(f"b{k}", spark.range(k))
        commit.append("a", spark.range(9))
        assert commit.read("a").count() == 12 and store.read("a").count() == 3
        raise RuntimeError("sixth table")
    assert store.version == 1 and store.tables() == ["a"] and rows(store.read("a")) == rows(before.read("a"))
    store.write("a", store.read("a").where("id > 0"))
    assert rows(before.read("a")) == [(0,), (1,), (2,)] and rows(store.read("a")) == [(1,), (2,)]
    assert store.vacuum(keep=1) and len(os.listdir(tmp_path / "s" / "a")) == 1 and rows(store.read("a")) == [(1,), (2,)]
    assert not any(name.startswith("b") and os.listdir(tmp_path / "s" / name) for name in os.listdir(tmp_path / "s"))


def test_of_two_writers_one_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write("a", spark.range(1))
    with pytest.raises(ConcurrentCommit), store.begin() as slow:
        slow.append("a", spark.range(5))
        store.append("a", spark.range(2))
    assert store.version == 2 and store.read("a").count() == 3


def test_parts_of_other_columns(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), KEYS)
    store.write("t", numbered(spark, [1, 2]))
    store.append("t", numbered(spark, [3], note="x").drop("v"))
    store.append("t", spark.createDataFrame([(4, 5)], "id int, v int"))
    assert store.columns("t") == ["id", "name", "v", "note"]
    assert rows(store.read("t")) == [(1, "n1", 10, None), (2, "n2", 20, None), (3, "n0", None, "x"), (4, None, 5, None)]
    assert store.last_id("t") == 4 and store.last_id("t", "v") == 20 and store.last_id("none") == 0


def test_missing_rows_by_whole_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "SMALL", 20)
    store, rng, held = Store(spark, str(tmp_path / "s"), KEYS), random.Random(2), set()
    for k in range(4):
        some = {(1000 * k + rng.randrange(400), f"n{rng.randrange(4)}") for _ in range(300)} - held
        held |= some
        store.append("t", spark.createDataFrame(sorted(some), "id long, name string"))
    asked = [(rng.randrange(3600), f"n{rng.randrange(5)}") for _ in range(500)] + rng.sample(sorted(held), 50) + [(None, "n1"), (7, None), (-5, "n0")]
    got = store.missing("t", spark.createDataFrame(asked, "id long, name string"))
    assert rows(got) == sorted((k for k in asked if k not in held), key=str)
    (key,) = [(k, n) for k, n in sorted(held) if k >= 2000][:1]
    assert len(store.holding("t", spark.createDataFrame([key], "id long, name string"))) == 1
    assert store.holding("t", spark.createDataFrame([(9_999, "n1"), (None, None)], "id long, name string")) == []
    absent = spark.createDataFrame([(k, "other") for k in range(3600)], "id long, name string")
    files = sum(len([f for f in os.listdir(tmp_path / "s" / p) if f.startswith("part-")]) for p in store.parts("t"))
    assert len(store.holding("t", absent.where("id < 40"))) < files / 2


def test_tables_with_text_keys_or_without_index(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), KEYS)
    store.write("words", spark.createDataFrame([("a", 1), ("b", 2)], "word string, n long"))
    assert rows(store.missing("words", spark.createDataFrame([("b",), ("c",)], "word string"))) == [("c",)]
    assert store.merge("words", spark.createDataFrame([("b", 5), ("d", 1)], "word string, n long"), add=("n",)) == 1
    assert rows(store.read("words")) == [("a", 1), ("b", 7), ("d", 1)]
    store.write("keyless", spark.range(1))
    with pytest.raises(ValueError):
        store.merge("keyless", spark.range(1))


def test_a_merge_replaces_only_files_that_hold_its_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"t": ("id",)})
    for k in range(10):
        store.append("t", spark.range(100 * k, 100 * k + 100).withColumn("v", F.col("id") * 2).withColumn("w", F.lit("old")).coalesce(1))
    parts = store.parts("t")
    pinned = store.at(store.version)
    changes = spark.range(300, 310).withColumn("w", F.lit("new")).unionByName(spark.createDataFrame([(5000, "born")], "id long, w string"))
    replaced = store.merge("t", changes)
    assert 1 <= replaced <= 4 and len(set(store.parts("t")) & set(parts)) == 9
    want = [(k, 2 * k, "new" if 300 <= k < 310 else "old") for k in range(1000)] + [(5000, None, "born")]
    assert rows(store.read("t")) == sorted(want, key=str) and pinned.read("t").where("w <> 'old'").isEmpty()
    assert rows(store.missing("t", spark.createDataFrame([(305,), (5000,), (5001,)], "id long"))) == [(5001,)]
    assert store.merge("t", spark.createDataFrame([(7000, "x")], "id long, w string")) == 0 and store.read("t").count() == 1002


def timings(spark, *keys):
    return spark.createDataFrame([(s, f, 1.0, 2) for s, f in keys], "search_id long, function string, total_time_ms double, num_calls long")


def test_late_children_of_loaded_searches(spark, tmp_path):
    raw, to = warehouse.Store(spark, str(tmp_path / "raw")), warehouse.Store(spark, str(tmp_path / "to"))
    raw.write("timing", timings(spark, (1, "SEE"), (2, "SEE")))
    warehouse.load(raw, to)
    raw.append("timing", timings(spark, (1, "ROOT"), (2, "SEE")))
    warehouse.load(raw, to, late=True)
    assert rows(to.read("search_timings").select("search_id", "function")) == [(1, "ROOT"), (1, "SEE"), (2, "SEE")]
    version = to.version
    warehouse.load(raw, to, late=True)
    assert to.version == version and to.read("search_timings").count() == 3
    raw.write("timing", timings(spark, (1, "ROOT"), (1, "SEE"), (2, "SEE"), (0, "SEE"), (2, "EVAL")))
    warehouse.load(raw, to, late=True)
    assert to.read("search_timings").count() == 5


def test_features_of_searches_that_grew_late(spark, tmp_path):
    from tests.test_library import START, raw_store
    from plyspark.operators import positions

    raw, step, whole = raw_store(spark, str(tmp_path / "raw"), range(1, 8)), *(warehouse.Store(spark, str(tmp_path / n)) for n in ("step", "whole"))
    facts = positions.position_features(spark.createDataFrame([(1, 1, START)], "search_id long, game_id long, fen string"))

    def loaded(to, full):
        warehouse.load(raw, to, full=full, late=True)
        if not to.exists("position_features"):
            to.write("position_features", facts)
        return warehouse.build_features(to, full=full)

    loaded(step, False)
    tree, steps = raw.read("searches_by_tree_depth"), raw.read("searches_by_iteration")
    raw.append("searches_by_tree_depth", tree.where("search_id = 3 AND depth = 4").withColumn("depth", F.lit(5).cast("long")))
    raw.append("searches_by_iteration", steps.where("search_id = 2 AND depth = 4").withColumn("depth", F.lit(5).cast("long")))
    raw.append("timing", timings(spark, (3, "ROOT")))
    assert set(loaded(step, False)) == {"search_tree_features", "search_iteration_features", "search_features"}
    loaded(whole, True)
    for t in ("search_tree_features", "search_iteration_features", "search_features"):
        a, b = step.read(t), whole.read(t).select(step.columns(t))
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), t
    assert loaded(step, False) == {}
