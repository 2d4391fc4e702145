"""Bucketed tables: joins and windows by their key without an exchange."""

import re

import pytest
from pyspark.sql import functions as F

from plyspark.functions import safe
from plyspark.operators import search
from plyspark.plans import layout
from plyspark.plans.entities import entity


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def dealt_by(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_wide_features_have_no_exchange_by_search(spark, sf_dir, tmp_path, shuffled_joins):
    of = lambda n: entity(spark, sf_dir, n)
    suites = of("suites").select("id", safe.last_part("path").alias("suite"), safe.trimmed_part("category", "-", 2).alias("position_name"), "move_is_correct")
    stored = layout.search_layout({n: of(n) for n in layout.SEARCH_KEYS}, str(tmp_path), 4)
    with layout.by_bucket(spark):
        wide = layout.wide_by_bucket(spark, stored, of("engines"), of("games"), suites)
        assert "search_id" not in dealt_by(wide)
        plain = search.wide_features(of("searches"), search.iteration_features(of("iterations")), of("timings"), of("positions"), of("engines"), of("games"), suites)
        assert dealt_by(plain).count("search_id") >= 2
        assert wide.count() == plain.count() and wide.drop("stddev_eval").exceptAll(plain.drop("stddev_eval")).isEmpty()


def test_buckets_of_an_earlier_session_are_read(spark, tmp_path, shuffled_joins):
    left = layout.bucketed(spark.range(200).withColumn("v", F.col("id") % 7), str(tmp_path), "id", 4)
    right = layout.bucketed(spark.range(0, 400, 2).select(F.col("id").alias("of"), F.lit("x").alias("w")), str(tmp_path), "of", 4)
    a, b = layout.opened(spark.newSession(), left), layout.opened(spark, right)
    assert a.count() == 200 and [f.name for f in a.schema] == ["id", "v"]
    joined = layout.opened(spark, left).join(b, F.col("id") == F.col("of"))
    assert dealt_by(joined) == [] and joined.count() == 100
    skewed = layout.bucketed(spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("id")), str(tmp_path), "id", 4)
    assert layout.opened(spark, skewed).groupBy("id").count().where("id = 1").first()["count"] == 700


def test_number_of_buckets():
    assert [layout.buckets_for(x << 20) for x in (0, 100, 2049, 10_000, 1 << 20)] == [8, 8, 16, 64, 4096]
