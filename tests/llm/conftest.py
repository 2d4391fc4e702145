import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, lang string, fp long, score double, base string, copies int"
#: Names that operators and stages might use for columns of their own.
CLASHING = ["_a", "_t", "_k", "_h", "_m", "_size", "_arrival", "arrival", "shard_id", "shard_file", "_bad", "bad", "_quality", "quality", "row", "size", "m", "total", "n", "key", "id", "known"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["an", "er", "th", "on", "in", "es"]) + rng.choice(["der", "lo", "mi", "ka", "tu"]) + rng.choice(["", "s", "na"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in each column, empty, blank and very long texts, ties, repeated rows, and names that operators use inside."""
    long_text = prose(5, 30_000)
    rows = [(k, prose(k, 40 + 7 * k), f"s{k % 3}", "en", k, 0.5, "x", 7) for k in range(1, 25)]
    rows += [(30, None, "s0", "en", 1, None, None, None), (31, "", None, None, None, 0.1, "y", 1), (32, " \n\t ", "s1", "fr", 2, 0.2, "z", 2)]
    rows += [(33, long_text, "s1", "en", 3, 0.3, "", 3), (34, long_text, "s2", "en", 3, 0.3, "", 3), (35, "one", "", "en", 4, 0.4, "b", 4), (36, "!!! ???", "s2", "en", 4, 0.4, "b", 4)]
    rows += [rows[0]] * 3 + [(None, prose(77, 60), "s1", "en", 1, 0.1, "n", 1), (None, None, None, None, None, None, None, None)]
    rows += [(40, "naïve Ünïcode 😀 text — twice", "s0", "de", 5, 0.6, "u", 5)]
    return rows


@pytest.fixture
def odd(spark, odd_rows):
    return clashing(spark.createDataFrame(odd_rows, SCHEMA))


def clashing(df):
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture
def nothing(spark):
    return clashing(spark.createDataFrame([], SCHEMA))
