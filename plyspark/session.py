"""Spark sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "plyspark", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; further settings by name with ``__`` for dots. ANSI stays on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
