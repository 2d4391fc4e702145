"""Engine logs (JSON lines) to raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.safe import at_or_zero
from ..operators.order import ranked
from ..operators.search import FH_BUCKETS
from ..schemas import GAME_LOG, ROOT_MOVES_LOG, SEARCH_LOG, TIMING_KEYS

#: Versions that are never logged; an engine's bare name is another, to be passed with these.
SKIPPED_VERSIONS = ("dev", "DEV", "Dev", "debug", "DEBUG", "Debug")


def json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines). Blank lines are neither; what isn't a JSON object is rejected.

    Records have ``_file`` and ``_at``: file and order within it, which is that of partitions and lines.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at")).where("trim(value) <> ''")
    parsed = lines.withColumn("r", F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull() | ~F.trim("value").startswith("{")
    return parsed.where(~bad).select("_file", "_at", *[F.col(f"r.`{n}`") for n in schema.names]), parsed.where(bad).select("_file", "value")


def line_count(spark: SparkSession, paths: str | list[str]) -> int:
    """Lines that aren't blank, for reconciliation."""
    return spark.read.text(paths).where("trim(value) <> ''").count()


def games(log: DataFrame, engines: DataFrame, start: int = 0, second_engine: int | None = None, experiment: int | None = None) -> DataFrame:
    """One row for each game: the first record gives what it is, each side's last record its engine; ``game_uuid`` stays as the key."""
    ids = engines.select(F.col("version").alias("engine_id"), F.col("id").alias("_engine"))
    rows = log.where("game_uuid IS NOT NULL").join(ids, "engine_id", "left").withColumn("_o", F.struct("_file", "_at"))
    white = F.coalesce(F.col("side") == "white", F.lit(False))
    last = lambda side: F.max_by(F.when(side, F.col("_engine")), F.when(side, F.col("_o")))
    kept = ["wtime", "btime", "winc", "binc", "movestogo", "depth", "nodes", "movetime", "result", "reason", "opening", "start_fen", "moves", "time_s"]
    one = rows.groupBy("game_uuid").agg(F.min_by(F.struct(*kept), "_o").alias("g"), F.min("_o").alias("_o"), last(white).alias("white_engine_id"), last(~white).alias("black_engine_id"))
    other = F.lit(second_engine).cast("long")
    out = ranked(one, ["_o"], start)
    return out.select(
        "id", "game_uuid", F.lit(experiment).cast("long").alias("experiment_id"), F.coalesce("white_engine_id", other).alias("white_engine_id"), F.coalesce("black_engine_id", other).alias("black_engine_id"),
        *[F.col(f"g.{c}") for c in kept if c not in ("reason", "moves", "time_s")], F.col("g.reason").alias("termination"), F.to_json("g.moves").alias("moves"), F.col("g.time_s").alias("run_time_s"),
    )


@dataclass
class Searches:
    """Raw tables of a search log; ``skipped`` are records of engines that are unknown or never logged."""

    searches: DataFrame
    iterations: DataFrame
    tree: DataFrame
    skipped: DataFrame


def _bucket(array: str, i: Column, k: int) -> Column:
    return F.get(F.get(F.col(array), i), F.lit(k))


def searches(log: DataFrame, engines: DataFrame, game_rows: DataFrame, start: int = 0, sts_id: int | None = None, skipped: tuple[str, ...] = SKIPPED_VERSIONS) -> Searches:
    """Searches with ids, and a row for each iteration and each depth of the tree.

    Arrays of a record are read side by side; the array of nodes tells how many rows there are, and where another is shorter the value is 0 (a bucket: NULL).
    """
    ids = engines.select(F.col("version").alias("engine_id"), F.col("id").alias("_engine"))
    known = log.join(ids, "engine_id", "left")
    skip = F.col("_engine").isNull() | F.coalesce(F.col("engine_id").isin(*skipped), F.lit(True))
    kept = ranked(known.where(~skip), ["_file", "_at"], start)
    kept = kept.join(game_rows.select("game_uuid", F.col("id").alias("game_id")), "game_uuid", "left")
    names = {"root_eval": "eval", "max_depth": "depth", "max_qdepth": "qdepth", "best_move": "move", "aspiration_fail_high_researches": "fail_high_researches", "aspiration_fail_low_researches": "fail_low_researches"}
    plain = ["fen", "ply", "time_ms", "root_eval", "completed_depth", "max_depth", "max_qdepth", "best_move", "nodes", "qnodes", "tt_stores", "tt_hits", "tt_fill", "fail_highs", "fail_lows", "aspiration_fail_high_researches", "aspiration_fail_low_researches", "see_prunes", "delta_prunes", "nmp", "nmp_failhigh", "tt_overwritten"]
    index = F.coalesce("fail_high_index", F.array().cast("array<bigint>"))
    header = kept.select(
        "id", "search_uuid", F.col("_engine").alias("engine_id"), "game_id", F.lit(sts_id).cast("long").alias("sts_id"), *[F.col(c).alias(names.get(c, c)) for c in plain],
        F.to_json("principal_variation").alias("principal_variation"), *[at_or_zero(index, k).alias(f"fh_index_{b}") for k, b in enumerate(FH_BUCKETS)], F.lit(None).cast("long").alias("pvs_researches"),
    )

    def exploded(prefix: str, columns: dict[str, str]) -> DataFrame:
        n = F.size(f"{prefix}_nodes")
        rows = kept.where(n > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
        value = lambda c: F.when(F.col("_i") >= F.coalesce(F.size(f"{prefix}_{c}"), F.lit(0)), 0).otherwise(F.get(f"{prefix}_{c}", F.col("_i")))
        out = [F.col("id").alias("search_id"), (F.col("_i") + 1).cast("long").alias("depth"), *[(F.when(F.get(f"{prefix}_{c}", F.col("_i")).isNotNull(), F.get(f"{prefix}_{c}", F.col("_i"))) if c == "move" else value(c)).alias(n) for c, n in columns.items()]]
        return rows.select(*out, *[_bucket(f"{prefix}_fh_index", F.col("_i"), k).alias(f"fh_index_{b}") for k, b in enumerate(FH_BUCKETS)])

    same = lambda text: {c: c for c in text.split()}
    iteration = same("time_ms eval move qdepth nodes qnodes") | {"ttstores": "tt_stores", "tthits": "tt_hits", "ttfill": "tt_fill"} | same("fail_highs fail_lows")
    iteration |= {"aspiration_failhigh_researches": "fail_high_researches", "aspiration_faillow_researches": "fail_low_researches"} | same("see_prunes delta_prunes pvs_researches nmp nmp_failhigh")
    tree = same("nodes qnodes tt_stores tt_hits fail_highs fail_lows see_prunes delta_prunes pvs_researches nmp nmp_failhigh")
    return Searches(header, exploded("itdepth", iteration), exploded("treedepth", tree), known.where(skip).select("search_uuid", "engine_id"))


def timings(spark: SparkSession, paths: str | list[str], search_rows: DataFrame) -> DataFrame:
    """(search_id, function, total_time_ms, num_calls): every key of a timing record that isn't reserved is a function."""
    lines = spark.read.text(paths).where("trim(value) <> ''").select(F.from_json("value", "map<string,string>").alias("m"))
    rows = lines.where("m['type'] = 'timing'").select(F.col("m")["search_uuid"].alias("search_uuid"), F.explode("m").alias("function", "v")).where(~F.col("function").isin(TIMING_KEYS))
    stats = F.from_json("v", "total_ms double, calls long")
    ids = search_rows.select("search_uuid", F.col("id").alias("search_id"))
    return rows.join(ids, "search_uuid").select("search_id", "function", F.coalesce(stats["total_ms"], F.lit(0.0)).alias("total_time_ms"), F.coalesce(stats["calls"], F.lit(0)).alias("num_calls"))


def root_moves(log: DataFrame, search_rows: DataFrame) -> DataFrame:
    ids = search_rows.select("search_uuid", F.col("id").alias("search_id"))
    rows = log.join(ids, "search_uuid").select("search_id", F.coalesce("depth", F.lit(0)).alias("depth"), F.posexplode("moves").alias("move_index", "m"))
    return rows.select("search_id", "depth", "move_index", F.coalesce("m.move", F.lit("")).alias("move"), "m.eval", "m.time_ms", "m.nodes")


def reconciled(expected: int, found: Searches) -> bool:
    """Whether every line is accounted for: inserted or skipped, counted as rows."""
    return found.searches.count() + found.skipped.count() == expected


GAME, SEARCH, ROOT_MOVES = GAME_LOG, SEARCH_LOG, ROOT_MOVES_LOG
