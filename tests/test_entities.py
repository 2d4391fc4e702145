"""Entities over the driver's tables."""

import random

import duckdb

from plyspark.operators import search
from plyspark.plans import entities
from plyspark.plans.catalogue import Query
from plyspark.plans.entities import entity


def test_timings_add_events_in_order(spark, tmp_path):
    rng, rows, expected = random.Random(1), [], {}
    for user in range(200):
        values = [rng.randrange(100, 9000) / 100 for _ in range(14)]
        values.append((150 - round(sum(values) * 100) % 100) / 100)  # sums end in .5
        total = 0.0
        for value in values:
            total += value
            rows.append((len(rows), user, "view", value))
        expected[user] = (float(int(total + 0.5)), len(values))
    schema = "event_id long, user_id long, event_type string, value double"
    rng.shuffle(rows)
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    found = {r.search_id: (r.total_time_ms, r.num_calls) for r in entity(spark, str(tmp_path), "timings").collect()}
    assert found == expected and len({t for t, _ in expected.values()}) > 100


def test_halves_are_rounded_as_in_sql(spark):
    query = Query(lambda spark, _: spark.range(2, 2000).selectExpr("id", "CAST(2 * id + 1 AS DOUBLE) / 2e6 * 1.37 AS x", "CAST(2 * id + 1 AS DOUBLE) / 2e6 AS y"), "SELECT range AS id, CAST(2 * range + 1 AS DOUBLE) / 2e6 * 1.37 AS x, CAST(2 * range + 1 AS DOUBLE) / 2e6 AS y FROM range(2, 2000)", ("x", "y"))
    rows = [tuple(r) for r in query.spark(spark, "").orderBy("id").collect()]
    assert rows == duckdb.sql(f"SELECT * FROM ({query.oracle()}) ORDER BY id").fetchall()


def test_large_tables_are_dealt_by_key(spark, sf_dir, monkeypatch):
    plain = {name: sorted(map(str, entity(spark, sf_dir, name).collect())) for name in entities.DEALT}
    monkeypatch.setattr(entities, "TASK_ROWS", 90)
    for name, rows in plain.items():
        dealt = entity(spark, sf_dir, name)
        assert sorted(map(str, dealt.collect())) == rows
        parts = -(-spark.read.parquet(f"{sf_dir}/{entities.DEALT[name][0]}.parquet").count() // 90)
        plan = entity(spark, sf_dir, name)._jdf.queryExecution().executedPlan().toString()
        assert f", {parts}), REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 1


def test_run_lengths_without_an_order_of_their_own(spark):
    moves = [None, None, "a", "b", "a", "a", None, "b", "b", "b"]
    counters = {c: 1 for c in [*search.COUNTERS, "nodes", "qnodes"]}
    rows = spark.createDataFrame([{"search_id": 1, "depth": k, "move": m, "eval": 1.0, "time_ms": 1.0, **counters} for k, m in enumerate(moves)], "search_id long, depth long, move string, eval double, time_ms double, " + ", ".join(f"{c} long" for c in counters))
    found = search.iteration_features(rows)
    assert [r.move_run_length for r in found.orderBy("depth").collect()] == [0, 1, 0, 0, 0, 1, 0, 0, 1, 2]
    assert found._jdf.queryExecution().executedPlan().toString().count("Sort [") <= 4
