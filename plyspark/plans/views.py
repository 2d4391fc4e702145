"""Report views: one function for each, from entity frames to a small result."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.safe import binned, guarded, ratio, sample_rows
from ..operators.search import FH_BUCKETS

def white_points() -> Column:
    return F.when(F.col("result") == "white", 1.0).when(F.col("result") == "draw", 0.5).otherwise(0.0)


def filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def crossfiltered(df: DataFrame, predicates: Mapping[str, Column], client: str) -> DataFrame:
    """``df`` under the predicates of all other clients, as linked charts filter each other."""
    return df.where(reduce(lambda a, b: a & b, [p for c, p in predicates.items() if c != client], F.lit(True)))


def summary(df: DataFrame, **metrics: Column) -> DataFrame:
    return df.agg(*[m.alias(n) for n, m in metrics.items()])


def counted(df: DataFrame, key: str | Column, name: str, k: int | None = None) -> DataFrame:
    """Rows by key; with ``k`` the most frequent, ties by key."""
    out = df.groupBy((F.col(key) if isinstance(key, str) else key).alias(name)).agg(F.count("*").alias("count"))
    return out.orderBy(F.desc("count"), F.asc_nulls_last(name)).limit(k) if k else out


def averaged(df: DataFrame, key: str, *metrics: str) -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(m).alias(m) for m in metrics])


def histogram(df: DataFrame, metric: str, step: float, by: str | None = None) -> DataFrame:
    keys = [binned(metric, step).alias("bin"), *([F.col(by)] if by else [])]
    return df.where(F.col(metric).isNotNull()).groupBy(*keys).agg(F.count("*").alias("count"))


# games and openings


def game_results(games: DataFrame) -> DataFrame:
    of = lambda r: F.count_if(F.col("result") == r)
    return summary(games, total=F.count("*"), white_wins=of("white"), black_wins=of("black"), draws=of("draw"), avg_time=F.avg("run_time_s"), n_openings=F.count_distinct("opening"))


def openings_summary(games: DataFrame) -> DataFrame:
    return summary(games.where(filled("opening")), total_games=F.count("*"), n_openings=F.count_distinct("opening"), n_eco=F.count_distinct("opening_eco"))


def opening_win_rate(games: DataFrame, least: int = 3, k: int = 25) -> DataFrame:
    out = games.where(filled("opening")).groupBy("opening").agg(F.count("*").alias("games"), F.avg(white_points()).alias("white_score"))
    return out.where(F.col("games") >= least).orderBy(F.desc("white_score"), "opening").limit(k)


def opening_depth(searches: DataFrame, least: int = 5, k: int = 25) -> DataFrame:
    out = searches.where(filled("game_opening")).groupBy(F.col("game_opening").alias("opening")).agg(F.avg("completed_depth").alias("avg_depth"), F.count("*").alias("n"))
    return out.where(F.col("n") >= least).orderBy(F.desc("avg_depth"), "opening").limit(k)


def eco_letters(games: DataFrame) -> DataFrame:
    return counted(games.where(filled("opening_eco")), F.substring("opening_eco", 1, 1), "eco_letter")


# engines


def engine_labels(engines: DataFrame) -> DataFrame:
    return engines.select("id", "name", "version", F.concat("name", F.lit(" ("), "version", F.lit(")")).alias("label"))


def by_engine(searches: DataFrame, engines: DataFrame, **metrics: Column) -> DataFrame:
    """Aggregates by engine, with its label; searches of unknown engines are left out."""
    labels = engine_labels(engines)
    joined = searches.join(labels, F.col("engine_id") == F.col("id"))
    return joined.groupBy("id", "name", "version").agg(F.first("label").alias("engine_label"), *[m.alias(n) for n, m in metrics.items()]).select("id", "engine_label", *metrics)


def engine_trend(wide: DataFrame, engines: DataFrame) -> DataFrame:
    s = wide.drop("id")
    means = {"avg_depth": "completed_depth", "avg_nodes": "total_nodes", "avg_time_ms": "total_time_ms", "avg_tt_hits": "total_tt_hits", "avg_fail_highs": "total_fail_highs", "avg_nmp": "total_nmp"}
    return by_engine(s, engines, **{n: F.avg(c) for n, c in means.items()}, n_searches=F.count("*"))


def pruning_by_engine(wide: DataFrame, engines: DataFrame) -> DataFrame:
    r = lambda c: F.avg(ratio(c, "total_nodes"))
    return by_engine(wide, engines, see_ratio=r("total_see_prunes"), delta_ratio=r("total_delta_prunes"), nmp_ratio=r("total_nmp"), nmp_failhigh_rate=F.avg(guarded("total_nmp_failhigh", "total_nmp")))


# search metrics


def search_summary(wide: DataFrame) -> DataFrame:
    return summary(wide, total=F.count("*"), avg_depth=F.avg("depth"), avg_nodes=F.avg("total_nodes"), avg_nps=F.avg("nps"), avg_time=F.avg("total_time_ms"), avg_tt_hit_ratio=F.avg("tt_hit_ratio"))


def overview_summary(wide: DataFrame) -> DataFrame:
    return summary(wide, avg_depth=F.avg("depth"), max_depth=F.max("depth"), avg_eval=F.avg("eval"), avg_nodes=F.avg("total_nodes"), avg_time=F.avg("total_time_ms"))


def overview_histogram(wide: DataFrame, metric: str, step: float) -> DataFrame:
    rule = {"eval": F.abs("eval") <= 1500, "total_nodes": F.col("total_nodes") > 0}.get(metric, F.lit(True))
    return histogram(wide.where(rule), metric, step)


def pruning_summary(wide: DataFrame) -> DataFrame:
    return summary(
        wide, total=F.count("*"), avg_see=F.avg("total_see_prunes"), avg_delta=F.avg("total_delta_prunes"), avg_nmp=F.avg("total_nmp"), avg_nmp_failhigh=F.avg("total_nmp_failhigh"),
        avg_nmp_ratio=F.avg("nmp_ratio"), avg_nmp_failhigh_rate=F.avg(guarded("total_nmp_failhigh", "total_nmp")),
    )


def pruning_by_depth(wide: DataFrame) -> DataFrame:
    r = lambda c, n: F.avg(ratio(c, "total_nodes")).alias(n)
    rows = wide.where(F.col("completed_depth").between(1, 30))
    return rows.groupBy(F.col("completed_depth").alias("depth")).agg(r("total_see_prunes", "see_ratio"), r("total_delta_prunes", "delta_ratio"), r("total_nmp", "nmp_ratio"))


def nmp_fail_rates(wide: DataFrame, step: float = 0.1) -> DataFrame:
    return histogram(wide.where("total_nmp > 0").select(ratio("total_nmp_failhigh", "total_nmp").alias("fail_rate")), "fail_rate", step)


# move ordering


def fail_high_shares(wide: DataFrame) -> DataFrame:
    """Share of each bucket in the sum of all buckets, in percent."""
    sums = wide.where("total_fh_index_0 IS NOT NULL").agg(F.count("*").alias("n"), *[F.sum(f"total_fh_index_{b}").alias(f"b{b}") for b in FH_BUCKETS])
    total = reduce(lambda a, b: a + b, [F.coalesce(f"b{b}", F.lit(0)) for b in FH_BUCKETS])
    return sums.select("n", *[(ratio(f"b{b}", total) * 100).alias(f"share_{b}") for b in FH_BUCKETS])


def fail_high_distribution(wide: DataFrame) -> DataFrame:
    """Buckets as rows: one scan, then an unpivot."""
    sums = wide.where("total_fh_index_0 IS NOT NULL").agg(F.sum("total_fail_highs").alias("whole"), *[F.sum(f"total_fh_index_{b}").cast("double").alias(b) for b in FH_BUCKETS])
    parts = ", ".join(f"'{b}', `{b}`, {k}" for k, b in enumerate(FH_BUCKETS))
    return sums.select("whole", F.expr(f"stack({len(FH_BUCKETS)}, {parts}) AS (bucket, part, ord)")).select("bucket", ratio("part", "whole").alias("ratio"), "ord")


def fail_high_by_depth(rows: DataFrame, depth: str, most: int, name: str = "depth") -> DataFrame:
    kept = rows.where(F.col("fh_index_0_ratio").isNotNull() & F.col(depth).between(1, most))
    return kept.groupBy(F.col(depth).alias(name)).agg(*[F.avg(f"fh_index_{b}_ratio").alias(f"idx{b}") for b in FH_BUCKETS])


def fail_high_by_engine(wide: DataFrame) -> DataFrame:
    kept = wide.where("total_fh_index_0 IS NOT NULL")
    return kept.groupBy("engine_name").agg(*[ratio(F.sum(f"total_fh_index_{b}"), F.sum("total_fail_highs")).alias(f"idx{b}_ratio") for b in FH_BUCKETS])


# positions and quality of evaluation


def matched() -> Column:
    return F.when(F.col("move") == F.col("sf_best_move"), 1.0).otherwise(0.0)


def error() -> Column:
    return F.abs(F.col("eval") - F.col("sf_eval"))


def judged(wide: DataFrame) -> DataFrame:
    return wide.where("sf_eval IS NOT NULL AND eval IS NOT NULL")


def eval_accuracy(wide: DataFrame) -> DataFrame:
    return summary(judged(wide), total_with_sf=F.count("*"), mae=F.avg(error()), median_ae=F.median(error()), best_move_match_rate=F.avg(matched()), stddev_diff=F.stddev_samp(F.col("eval") - F.col("sf_eval")))


def eval_differences(wide: DataFrame, step: float = 25) -> DataFrame:
    return histogram(judged(wide).where(error() < 500).select((F.col("eval") - F.col("sf_eval")).alias("d")), "d", step)


def move_ranks(wide: DataFrame) -> DataFrame:
    label = F.when(F.col("move") == F.col("sf_best_move"), "best").otherwise("other")
    return counted(wide.where("sf_best_move IS NOT NULL AND move IS NOT NULL"), label, "rank_label")


def agreement_by_depth(wide: DataFrame, least: int = 5) -> DataFrame:
    rows = wide.where("sf_best_move IS NOT NULL AND move IS NOT NULL AND completed_depth BETWEEN 1 AND 30")
    return rows.groupBy(F.col("completed_depth").alias("depth")).agg(F.avg(matched()).alias("agreement_rate"), F.count("*").alias("n")).where(F.col("n") >= least)


def blunders(wide: DataFrame, least: int = 200) -> DataFrame:
    return summary(judged(wide).where(error() > least), count=F.count("*"))


def eval_scatter(wide: DataFrame, n: int = 3000) -> DataFrame:
    rows = judged(wide).where((F.abs("eval") < 1000) & (F.abs("sf_eval") < 1000))
    return sample_rows(rows.select("search_id", "eval", "sf_eval"), ["search_id"], n)


def phase_summary(wide: DataFrame) -> DataFrame:
    return wide.where(filled("game_phase")).groupBy("game_phase").agg(F.count("*").alias("count"), F.avg("completed_depth").alias("avg_depth"), F.avg("nps").alias("avg_nps"))


def accuracy_by_phase(wide: DataFrame) -> DataFrame:
    return judged(wide).where(filled("game_phase")).groupBy("game_phase").agg(F.avg(matched()).alias("match_rate"), F.avg(error()).alias("mae"), F.count("*").alias("n"))


def depth_by_type(wide: DataFrame, least: int = 5) -> DataFrame:
    return wide.where(filled("position_type")).groupBy("position_type").agg(F.avg("completed_depth").alias("avg_depth"), F.count("*").alias("n")).where(F.col("n") >= least)


# timing


def timing_by_function(timings: DataFrame, k: int = 15) -> DataFrame:
    rows = timings.where(F.col("function") != "ROOT").groupBy("function")
    return rows.agg(ratio(F.sum("total_time_ms"), F.sum("num_calls")).alias("ms_per_call"), F.sum("total_time_ms").alias("total_ms"), F.sum("num_calls").alias("calls")).orderBy(F.desc("total_ms"), "function").limit(k)


def timing_summary(timings: DataFrame) -> DataFrame:
    return summary(timings, rows=F.count("*"), n_functions=F.count_distinct("function"), n_searches=F.count_distinct("search_id"), total_ms=F.sum("total_time_ms"))


def time_management(wide: DataFrame) -> DataFrame:
    return summary(wide, avg_time=F.avg("total_time_ms"), median_time=F.median("total_time_ms"), max_time=F.max("total_time_ms"), avg_nps=F.avg("nps"), avg_depth=F.avg("completed_depth"))


def time_by_depth(iterations: DataFrame) -> DataFrame:
    return iterations.groupBy("depth").agg(F.sum("time_ms").alias("total_ms"))


# root moves


def root_move_summary(moves: DataFrame) -> DataFrame:
    return summary(moves, rows=F.count("*"), n_moves=F.count_distinct("move"), avg_eval=F.avg("eval"), avg_nodes=F.avg("nodes"), max_nodes=F.max("nodes"))


def root_moves_by(moves: DataFrame, metric: str, k: int = 20) -> DataFrame:
    return moves.groupBy("move").agg(F.avg(metric).alias(f"avg_{metric}"), F.count("*").alias("n")).orderBy(F.desc(f"avg_{metric}"), "move").limit(k)


# sequential tests

PASSED, FAILED = ["pass", "H1"], ["fail", "H0"]


def sprt_summary(runs: DataFrame) -> DataFrame:
    return summary(
        runs, total=F.count("*"), passed=F.count_if(F.col("result").isin(PASSED)), failed=F.count_if(F.col("result").isin(FAILED)),
        open=F.count_if(F.col("result").isNull() | (F.col("result") == "inconclusive")), avg_games=F.avg("num_games"),
    )


def freshness(df: DataFrame, key: str = "id") -> DataFrame:
    return summary(df, n=F.count("*"), last_id=F.coalesce(F.max(key), F.lit(0)))
