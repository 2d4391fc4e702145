"""Feature tables of searches: by iteration, by tree depth, and one wide row for each search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.safe import divided, geo_mean, latest_known, ratio, ratio_not_one

#: Fixed values of the data model.
FIRST_ASPIRATION_DEPTH = 6
FH_BUCKETS = ["0", "1", "2", "3", "4to7", "8plus"]
TIMED = {
    "make_move": "MAKEMOVE", "unmake_move": "UNMAKE_MOVE", "movegen": "MOVEGEN", "move_order": "SCORE_ORDER", "nnue": "NNUE",
    "static_eval": "EVAL", "see": "SEE", "tt_probe": "TT_PROBE", "tt_store": "TT_STORE",
}
COUNTERS = ["tt_stores", "tt_hits", "fail_highs", "fail_lows", *[f"fh_index_{b}" for b in FH_BUCKETS], "see_prunes", "delta_prunes", "pvs_researches", "nmp", "nmp_failhigh"]


def _shares() -> dict[str, Column]:
    """Ratios of a row's counters, the same for iterations and tree depths."""
    per_node = {"qratio": "qnodes", "tt_hit_ratio": "tt_hits", "tt_store_ratio": "tt_stores", "fail_high_ratio": "fail_highs", "fail_low_ratio": "fail_lows", "nmp_ratio": "nmp", "pvs_research_ratio": "pvs_researches"}
    found = {name: ratio(part, "total_nodes") for name, part in per_node.items()}
    found |= {f"fh_index_{b}_ratio": ratio(f"fh_index_{b}", "fail_highs") for b in FH_BUCKETS}
    found |= {"see_prune_ratio": ratio("see_prunes", "qnodes"), "delta_prune_ratio": ratio("delta_prunes", "qnodes")}
    found |= {"prune_ratio": ratio(F.col("see_prunes") + F.col("delta_prunes"), "qnodes"), "nmp_failhigh_ratio": ratio("nmp_failhigh", "nmp")}
    return found


def iteration_features(iterations: DataFrame, after: int | None = None) -> DataFrame:
    """A row for each (search_id, depth): shares, growth against the depth before, evaluation and move stability.

    ``move_stability`` counts rows since a change by the difference of two row numbers, whose value two moves of a search may
    share; ``move_run_length`` tells these apart. Only searches over ``after`` where that is given. All windows are by search,
    so there is one shuffle, and three orders: a search's moves, its depths, and rows of one difference.
    """
    rows = iterations if after is None else iterations.where(F.col("search_id") > after)
    by_depth = Window.partitionBy("search_id").orderBy("depth")
    rolling = by_depth.rowsBetween(-5, Window.currentRow)
    rows = rows.withColumn("total_nodes", F.col("nodes") + F.col("qnodes"))
    rows = rows.withColumn("of_move", F.row_number().over(Window.partitionBy("search_id", "move").orderBy("depth")))
    before = lambda c: F.lag(c).over(by_depth)
    flips = ((F.col("eval") > 0) & (before("eval") < 0)) | ((F.col("eval") < 0) & (before("eval") > 0))
    at = F.row_number().over(by_depth)
    # the last row whose move isn't that of the row before
    rows = rows.withColumns({"at": at, "move_grp": at - F.col("of_move"), "change": F.when((at == 1) | ~F.col("move").eqNullSafe(before("move")), at)})
    rows = rows.withColumns(
        _shares()
        | {
            "running_time_ms": F.sum("time_ms").over(by_depth),
            "nps": ratio("total_nodes", F.col("time_ms") / 1000),
            "time_increase_ratio": divided("time_ms", before("time_ms")),
            "ebf": divided("total_nodes", before("total_nodes")),
            "qebf": divided("qnodes", before("qnodes")),
            "prior_eval_delta": F.col("eval") - before("eval"),
            "first_eval_delta": F.col("eval") - F.first("eval").over(by_depth),
            "eval_sign_flips": F.when(flips, 1).otherwise(0),
            "stddev_eval": F.stddev_samp("eval").over(by_depth),
            "stddev_last5_eval": F.stddev_samp("eval").over(rolling),
            "move_stability": (F.row_number().over(Window.partitionBy("search_id", "move_grp").orderBy("depth")) - 1).cast("long"),
            "move_run_length": (F.col("at") - F.max("change").over(by_depth.rowsBetween(Window.unboundedPreceding, Window.currentRow))).cast("long"),
        }
    )
    return rows.drop("of_move", "at", "move_grp", "change")


def tree_features(tree: DataFrame, after: int | None = None) -> DataFrame:
    """A row for each (search_id, depth) of the search tree, with shares and branching factors."""
    rows = tree if after is None else tree.where(F.col("search_id") > after)
    by_depth = Window.partitionBy("search_id").orderBy("depth")
    rows = rows.withColumn("total_nodes", F.col("nodes") + F.col("qnodes"))
    growth = lambda c: ratio(c, F.lag(c).over(by_depth))
    return rows.withColumns(_shares() | {"ebf": growth("total_nodes"), "qebf": growth("qnodes")})


def pivoted_timings(timings: DataFrame) -> DataFrame:
    """One row for each search: total and mean time of each timed function, and of the whole search."""
    of = lambda f, value: F.max(F.when(F.col("function") == f, value))
    each = ratio("total_time_ms", "num_calls")
    columns = [of("ROOT", F.col("total_time_ms")).alias("total_search_time")]
    for name, function in TIMED.items():
        columns += [of(function, F.col("total_time_ms")).alias(f"{name}_total_ms"), of(function, each).alias(f"{name}_avg_ms")]
    return timings.groupBy("search_id").agg(*columns)


def iteration_rollup(features: DataFrame) -> DataFrame:
    """One row for each search over its iterations."""
    shape = {
        "nps": "avg stddev peak worst final", "qratio": "avg max stddev", "ebf": "avg max geo_mean", "qebf": "avg max geo_mean",
        "tt_hit_ratio": "avg max stddev", "tt_store_ratio": "avg max stddev", "fail_high_ratio": "avg max", "fail_low_ratio": "avg max",
        **{f"fh_index_{b}_ratio": "avg" for b in FH_BUCKETS}, "see_prune_ratio": "avg", "delta_prune_ratio": "avg", "prune_ratio": "avg",
        "fail_high_researches": "max", "fail_low_researches": "max", "nmp_ratio": "avg max", "nmp_failhigh_ratio": "avg",
        "pvs_research_ratio": "avg max", "move_stability": "max final", "eval": "max avg stddev",
    }
    how = {
        "avg": F.avg, "max": F.max, "stddev": F.stddev_samp, "peak": F.max, "worst": F.min,
        "final": lambda c: latest_known(c, "depth"), "geo_mean": lambda c: geo_mean(c, natural=False),
    }
    columns = [how[kind](metric).alias(f"{kind}_{metric}") for metric, kinds in shape.items() for kind in kinds.split()]
    true_means = [geo_mean(m).alias(f"true_geo_mean_{m}") for m in ("ebf", "qebf")]
    return features.groupBy("search_id").agg(*columns, *true_means, latest_known("eval_sign_flips", "depth").alias("eval_sign_flips"))


def move_rank(move: Column, pv: Column, most: int = 5) -> Column:
    """1..5 where the move stands in a JSON array of moves, 0 where not, NULL without move, array or elements."""
    moves = F.slice(F.from_json(pv, "array<string>"), 1, most)
    place = F.array_position(moves, move)
    return F.when(move.isNull() | pv.isNull(), None).when(place > 0, place).when(F.exists(moves, lambda x: x.isNotNull()), F.lit(0))


def outcome_score() -> Column:
    """1 for the engine's win, 0 for a draw, else -1, also where there is no game."""
    own_win = ((F.col("s.engine_id") == F.col("g.white_engine_id")) & (F.col("g.result") == "white")) | ((F.col("s.engine_id") == F.col("g.black_engine_id")) & (F.col("g.result") == "black"))
    return F.when(own_win, 1).when(F.col("g.result") == "draw", 0).otherwise(-1)


#: Wide names of position feature columns that aren't just prefixed.
_POSITION_NAMES = {"game_phase": "game_phase", "position_type": "position_type", "pos_tactical": "position_tactical_score", "pos_positional": "position_positional_score", "pos_endgame": "position_endgame_score", "balance": "position_balance"}


def search_shares() -> dict[str, Column]:
    """Ratios of a search row's own counters to all its nodes."""
    per_node = {"qratio": "qnodes", "tt_hit_ratio": "tt_hits", "tt_store_ratio": "tt_stores", "fail_high_ratio": "fail_highs", "fail_low_ratio": "fail_lows", "nmp_ratio": "nmp"}
    return {name: ratio(part, F.col("nodes") + F.col("qnodes")) for name, part in per_node.items()}


def search_features(searches: DataFrame) -> DataFrame:
    """What a search row gives by itself, without a join: its counters under the names of reports, ratios, and how its move and evaluation compare."""
    c = lambda name, alias: F.col(name).alias(alias)
    total = F.col("nodes") + F.col("qnodes")
    depths = F.greatest(F.lit(1), 1 + F.col("depth") - FIRST_ASPIRATION_DEPTH)
    rank = move_rank(F.col("move"), F.col("sf_pv"))
    first = move_rank(F.col("move"), F.col("sf_pv"), 1)
    counted = ["tt_stores", "tt_hits", "fail_highs", "fail_high_researches", "fail_low_researches", *[f"fh_index_{b}" for b in FH_BUCKETS], "see_prunes", "delta_prunes", "nmp", "tt_overwritten"]
    return searches.select(
        c("id", "search_id"), "fen", "ply", "engine_id", "game_id", "sts_id",
        c("time_ms", "total_time_ms"), c("eval", "final_eval"), c("move", "best_move"), "move", "principal_variation", "completed_depth", c("depth", "max_depth"), c("qdepth", "max_qdepth"),
        c("nodes", "total_internal_nodes"), c("qnodes", "total_qnodes"), total.alias("total_nodes"), *[c(x, f"total_{x}") for x in counted], c("fail_lows", "total_fail_low"),
        c("nmp_failhigh", "total_nmp_fail"), c("nmp_failhigh", "total_nmp_failhigh"), "tt_hits", "fail_highs", "sf_eval", "sf_best_move", "sf_pv", "eval", "depth",
        (F.col("eval") - F.col("sf_eval")).alias("eval_diff"), rank.alias("engine_move_rank"),
        F.when(F.col("move").isNull() | F.col("sf_pv").isNull(), None).otherwise(F.coalesce(first, F.lit(0)).cast("int")).alias("best_move_match"),
        ratio(total, F.col("time_ms") / 1000).alias("nps"), *[x.alias(n) for n, x in search_shares().items()], *[ratio_not_one(f"fh_index_{b}", "fail_highs").alias(f"fh_index_{b}_ratio") for b in FH_BUCKETS],
        ratio("fail_high_researches", depths).alias("fail_high_researches_per_depth"), ratio("fail_low_researches", depths).alias("fail_low_researches_per_depth"),
        ratio("nmp_failhigh", "nmp").alias("nmp_failhigh_ratio"),
    )


def with_positions(rows: DataFrame, positions: DataFrame) -> DataFrame:
    """Search rows with what their position gives, under the names of reports."""
    names = {x: _POSITION_NAMES.get(x, f"position_{x}") for x in positions.columns if x not in ("search_id", "game_id", "fen")}
    own = positions.select(F.col("search_id").alias("of_search"), F.col("position_type").alias("pos_label"), *[F.col(x).alias(n) for x, n in names.items()])
    return rows.join(own, F.col("search_id") == F.col("of_search"), "left").drop("of_search")


def wide_features(searches: DataFrame, iteration_features: DataFrame, timings: DataFrame, positions: DataFrame, engines: DataFrame, games: DataFrame, suites: DataFrame, after: int | None = None) -> DataFrame:
    """One wide row for each search: the engine, game and suite it is of, its counters and ratios, and what its iterations, timings and position give.

    Children are aggregated to one row for each search before they are joined. With ``after``, every branch is cut to later searches first.
    Reports that need less than all of this read ``search_features`` and join what they need.
    """
    cut = lambda df, key: df if after is None else df.where(F.col(key) > after)
    rollup = iteration_rollup(cut(iteration_features, "search_id"))
    times = pivoted_timings(cut(timings, "search_id"))
    s = with_positions(search_features(cut(searches, "id")), cut(positions, "search_id")).alias("s")
    joined = (
        s.join(rollup.alias("i"), F.col("s.search_id") == F.col("i.search_id"), "left")
        .join(times.alias("t"), F.col("s.search_id") == F.col("t.search_id"), "left")
        .join(engines.alias("e"), F.col("s.engine_id") == F.col("e.id"), "left")
        .join(games.alias("g"), F.col("s.game_id") == F.col("g.id"), "left")
        .join(suites.alias("u"), F.col("s.sts_id") == F.col("u.id"), "left")
    )
    c = lambda name, alias: F.col(name).alias(alias)
    columns = [
        "s.*", c("e.name", "engine_name"), c("e.version", "engine_version"), outcome_score().alias("game_score"), c("g.opening", "game_opening"), c("g.opening_eco", "game_eco"),
        c("u.suite", "sts_suite"), c("u.position_name", "sts_position_name"), c("u.move_is_correct", "sts_move_is_correct"),
        *[F.col(f"i.{x}") for x in rollup.columns if x != "search_id"], ratio_not_one("i.eval_sign_flips", "s.depth").alias("eval_sign_flips_per_depth"),
    ]
    for name in TIMED:
        columns += [F.col(f"t.{name}_avg_ms"), divided(100 * F.col(f"t.{name}_total_ms"), "s.total_time_ms").alias(f"{name}_perc_total_time")]
    return joined.select(*columns)
