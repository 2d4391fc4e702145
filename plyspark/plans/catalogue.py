"""The query catalogue: name -> (Spark query, DuckDB oracle).

Keys begin with the inventory's IDs. Doubles are rounded to six digits on both sides, and what isn't finite is NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import elo, safe
from ..operators import match, quality, search
from ..operators.search import FH_BUCKETS, TIMED
from ..scratch import shared_folder
from . import layout, paths, views
from .entities import entity, with_entities


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = ()

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(spark, sf_dir)
        # of a scaled double, as DuckDB rounds: of its shortest text, where Spark's round(c, 6) begins, a half may be on the other side
        finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.when(F.abs(c) < 1e300, F.round(c * 1e6) / 1e6).otherwise(c))
        return df.select(*[finite(F.col(f"`{n}`")).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sql = with_entities(self.sql)
        if not self.doubles:
            return sql
        finite = ", ".join(f'CASE WHEN isfinite(CAST("{c}" AS DOUBLE)) THEN round(CAST("{c}" AS DOUBLE), 6) END AS "{c}"' for c in self.doubles)
        return f"SELECT * REPLACE ({finite}) FROM ({sql}) AS q"


QUERIES: dict[str, Query] = {}


def add(name: str, run: Callable[..., DataFrame], sql: str | None, doubles: str = "") -> None:
    """``run`` takes frames of the entities that its parameters name, or (spark, sf_dir)."""
    names = [n for n in run.__code__.co_varnames[: run.__code__.co_argcount] if not n.startswith("_")]
    if names[:2] == ["spark", "sf_dir"]:
        call = run
    else:
        call = lambda spark, sf_dir: run(*[_frame(spark, sf_dir, n) for n in names])
    QUERIES[name] = Query(call, sql, tuple(doubles.split()))


def _frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "wide":
        return wide(spark, sf_dir)
    if name == "searched":
        return search.search_features(entity(spark, sf_dir, "searches"))
    if name == "searched_by_name":
        names = entity(spark, sf_dir, "engines").select(F.col("id").alias("engine_id"), F.col("name").alias("engine_name"))
        return _frame(spark, sf_dir, "searched").join(names, "engine_id", "left")
    if name == "searched_openings":
        names = entity(spark, sf_dir, "games").select(F.col("id").alias("game_id"), F.col("opening").alias("game_opening"))
        return _frame(spark, sf_dir, "searched").join(names, "game_id", "left")
    if name == "searched_positions":
        return search.with_positions(_frame(spark, sf_dir, "searched"), entity(spark, sf_dir, "positions"))
    if name == "iteration_rows":
        return search.iteration_features(entity(spark, sf_dir, "iterations"))
    if name == "tree_rows":
        return search.tree_features(entity(spark, sf_dir, "tree"))
    if name in ("customer", "orders", "lineitem", "events", "part", "nation", "pages", "labels", "embeddings", "conversations", "documents"):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return entity(spark, sf_dir, name)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda n: entity(spark, sf_dir, n)
    suites = of("suites").select("id", safe.last_part("path").alias("suite"), safe.trimmed_part("category", "-", 2).alias("position_name"), "move_is_correct")
    return search.wide_features(of("searches"), search.iteration_features(of("iterations")), of("timings"), of("positions"), of("engines"), of("games"), suites)


def wide_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table from searches and children stored in buckets."""
    of = lambda n: entity(spark, sf_dir, n)
    suites = of("suites").select("id", safe.last_part("path").alias("suite"), safe.trimmed_part("category", "-", 2).alias("position_name"), "move_is_correct")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = layout.search_layout({n: of(n) for n in layout.SEARCH_KEYS}, shared_folder(spark, "buckets"), buckets)
    return layout.wide_by_bucket(spark, stored, of("engines"), of("games"), suites).drop("avg_eval", "stddev_eval")


# SQL of the feature tables


def _n(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _shares_sql(total: str) -> dict[str, str]:
    per = {"qratio": "qnodes", "tt_hit_ratio": "tt_hits", "tt_store_ratio": "tt_stores", "fail_high_ratio": "fail_highs", "fail_low_ratio": "fail_lows", "nmp_ratio": "nmp", "pvs_research_ratio": "pvs_researches"}
    out = {k: _n(v, total) for k, v in per.items()} | {f"fh_index_{b}_ratio": _n(f"fh_index_{b}", "fail_highs") for b in FH_BUCKETS}
    return out | {"see_prune_ratio": _n("see_prunes", "qnodes"), "delta_prune_ratio": _n("delta_prunes", "qnodes"), "prune_ratio": _n("(see_prunes + delta_prunes)", "qnodes"), "nmp_failhigh_ratio": _n("nmp_failhigh", "nmp")}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


_W = "(PARTITION BY search_id ORDER BY depth)"
ITERATION = _shares_sql("total_nodes") | {
    "running_time_ms": f"sum(time_ms) OVER {_W}", "nps": _n("total_nodes", "(time_ms / 1000)"),
    "time_increase_ratio": f"CAST(time_ms AS DOUBLE) / lag(time_ms) OVER {_W}", "ebf": f"CAST(total_nodes AS DOUBLE) / CAST(lag(total_nodes) OVER {_W} AS DOUBLE)", "qebf": f"CAST(qnodes AS DOUBLE) / CAST(lag(qnodes) OVER {_W} AS DOUBLE)",
    "prior_eval_delta": f"eval - lag(eval) OVER {_W}", "first_eval_delta": f"eval - first_value(eval) OVER {_W}",
    "eval_sign_flips": f"CASE WHEN sign(eval) * sign(lag(eval) OVER {_W}) < 0 THEN 1 ELSE 0 END",
    "stddev_eval": f"stddev_samp(eval) OVER {_W}", "stddev_last5_eval": "stddev_samp(eval) OVER (PARTITION BY search_id ORDER BY depth ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)",
    "move_stability": "row_number() OVER (PARTITION BY search_id, grp ORDER BY depth) - 1", "move_run_length": "row_number() OVER (PARTITION BY search_id, grp, move ORDER BY depth) - 1",
}
ITERATION_SQL = f"""SELECT * EXCLUDE (grp), {_select(ITERATION)} FROM (SELECT *, nodes + qnodes AS total_nodes,
    row_number() OVER {_W} - row_number() OVER (PARTITION BY search_id, move ORDER BY depth) AS grp FROM iterations) AS b"""
TREE = _shares_sql("total_nodes") | {"ebf": f"CAST(total_nodes AS DOUBLE) / NULLIF(lag(total_nodes) OVER {_W}, 0)", "qebf": f"CAST(qnodes AS DOUBLE) / NULLIF(lag(qnodes) OVER {_W}, 0)"}
TREE_SQL = f"SELECT *, {_select(TREE)} FROM (SELECT *, nodes + qnodes AS total_nodes FROM tree) AS b"
_ITERATION_DOUBLES = " ".join(k for k in ITERATION if k not in ("eval_sign_flips", "move_stability", "move_run_length"))

TIMING = {"total_search_time": "max(total_time_ms) FILTER (function = 'ROOT')"}
for _name, _f in TIMED.items():
    TIMING |= {f"{_name}_total_ms": f"max(total_time_ms) FILTER (function = '{_f}')", f"{_name}_avg_ms": f"max({_n('total_time_ms', 'num_calls')}) FILTER (function = '{_f}')"}
TIMING_SQL = f"SELECT search_id, {_select(TIMING)} FROM timings GROUP BY search_id"

ROLLUP: dict[str, str] = {"avg_nps": "avg(nps)", "stddev_nps": "stddev_samp(nps)", "peak_nps": "max(nps)", "worst_nps": "min(nps)", "final_nps": "max_by(nps, depth)"}
for _m, _kinds in {"qratio": "ams", "ebf": "amg", "qebf": "amg", "tt_hit_ratio": "ams", "tt_store_ratio": "ams", "fail_high_ratio": "am", "fail_low_ratio": "am", **{f"fh_index_{b}_ratio": "a" for b in FH_BUCKETS},
                   "see_prune_ratio": "a", "delta_prune_ratio": "a", "prune_ratio": "a", "fail_high_researches": "m", "fail_low_researches": "m", "nmp_ratio": "am", "nmp_failhigh_ratio": "a", "pvs_research_ratio": "am"}.items():
    for _k in _kinds:
        ROLLUP |= {"a": {f"avg_{_m}": f"avg({_m})"}, "m": {f"max_{_m}": f"max({_m})"}, "s": {f"stddev_{_m}": f"stddev_samp({_m})"}, "g": {f"geo_mean_{_m}": f"exp(avg(log10(CASE WHEN {_m} > 0 THEN {_m} ELSE 1 END)))", f"true_geo_mean_{_m}": f"exp(avg(ln(CASE WHEN {_m} > 0 THEN {_m} ELSE 1 END)))"}}[_k]
ROLLUP |= {"max_move_stability": "max(move_stability)", "final_move_stability": "max_by(move_stability, depth)", "max_eval": "max(eval)", "avg_eval": "avg(eval)", "stddev_eval": "stddev_samp(eval)", "eval_sign_flips": "max_by(eval_sign_flips, depth)"}
#: Growth of a search whose nodes were 0 isn't finite, and its standard deviation and means differ between engines; the rollup's oracle takes finite growth only.
ROLLUP_SQL = f"SELECT search_id, {_select(ROLLUP)} FROM ({ITERATION_SQL}) AS f GROUP BY search_id"
_ROLLUP_INTS = {"max_fail_high_researches", "max_fail_low_researches", "max_move_stability", "final_move_stability", "eval_sign_flips"}
_ROLLUP_DOUBLES = " ".join(k for k in ROLLUP if k not in _ROLLUP_INTS)

_TOTAL = "(s.nodes + s.qnodes)"
_BY_ONE = lambda a, b: f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 1)"
_RANKS = " ".join(f"WHEN json_extract_string(s.sf_pv, '$[{k}]') = s.move THEN {k + 1}" for k in range(5))
WIDE: dict[str, str] = {
    "search_id": "s.id", "fen": "s.fen", "ply": "s.ply", "engine_id": "s.engine_id", "engine_name": "e.name", "engine_version": "e.version", "game_id": "s.game_id",
    "game_score": "CASE WHEN s.engine_id = g.white_engine_id AND g.result = 'white' OR s.engine_id = g.black_engine_id AND g.result = 'black' THEN 1 WHEN g.result = 'draw' THEN 0 ELSE -1 END",
    "game_opening": "g.opening", "game_eco": "g.opening_eco", "sts_id": "s.sts_id", "sts_suite": "list_extract(string_split(u.path, '\\'), -1)", "sts_position_name": "trim(split_part(u.category, '-', 2))", "sts_move_is_correct": "u.move_is_correct",
    "total_time_ms": "s.time_ms", "final_eval": "s.eval", "best_move": "s.move", "move": "s.move", "principal_variation": "s.principal_variation", "completed_depth": "s.completed_depth", "max_depth": "s.depth", "max_qdepth": "s.qdepth",
    "total_internal_nodes": "s.nodes", "total_qnodes": "s.qnodes", "total_nodes": _TOTAL,
    **{f"total_{x}": f"s.{x}" for x in ["tt_stores", "tt_hits", "fail_highs", "fail_high_researches", "fail_low_researches", *[f"fh_index_{b}" for b in FH_BUCKETS], "see_prunes", "delta_prunes", "nmp", "tt_overwritten"]},
    "total_fail_low": "s.fail_lows", "total_nmp_fail": "s.nmp_failhigh", "total_nmp_failhigh": "s.nmp_failhigh", "tt_hits": "s.tt_hits", "fail_highs": "s.fail_highs", "sf_eval": "s.sf_eval", "sf_best_move": "s.sf_best_move", "sf_pv": "s.sf_pv", "eval": "s.eval", "depth": "s.depth",
    "eval_diff": "s.eval - s.sf_eval", "engine_move_rank": f"CASE WHEN s.move IS NULL OR s.sf_pv IS NULL THEN NULL {_RANKS} WHEN json_array_length(s.sf_pv) > 0 THEN 0 END",
    "best_move_match": "CASE WHEN s.move IS NULL OR s.sf_pv IS NULL THEN NULL WHEN json_extract_string(s.sf_pv, '$[0]') = s.move THEN 1 ELSE 0 END",
    "nps": _n(_TOTAL, "(s.time_ms / 1000)"), "qratio": _n("s.qnodes", _TOTAL), "tt_hit_ratio": _n("s.tt_hits", _TOTAL), "tt_store_ratio": _n("s.tt_stores", _TOTAL), "fail_high_ratio": _n("s.fail_highs", _TOTAL), "fail_low_ratio": _n("s.fail_lows", _TOTAL),
    **{f"fh_index_{b}_ratio": _BY_ONE(f"s.fh_index_{b}", "s.fail_highs") for b in FH_BUCKETS},
    "fail_high_researches_per_depth": "CAST(s.fail_high_researches AS DOUBLE) / greatest(1, 1 + s.depth - 6)", "fail_low_researches_per_depth": "CAST(s.fail_low_researches AS DOUBLE) / greatest(1, 1 + s.depth - 6)",
    "nmp_ratio": _n("s.nmp", _TOTAL), "nmp_failhigh_ratio": _n("s.nmp_failhigh", "s.nmp"),
    **{k: f"i.{k}" for k in ROLLUP}, "eval_sign_flips_per_depth": _BY_ONE("i.eval_sign_flips", "s.depth"),
}
for _name in TIMED:
    WIDE |= {f"{_name}_avg_ms": f"t.{_name}_avg_ms", f"{_name}_perc_total_time": f"100 * t.{_name}_total_ms / s.time_ms"}
WIDE |= {"pos_label": "p.position_type", "game_phase": "p.game_phase", "position_type": "p.position_type", "position_tactical_score": "p.pos_tactical", "position_positional_score": "p.pos_positional", "position_endgame_score": "p.pos_endgame", "position_balance": "p.balance"}
WIDE_SQL = f"""SELECT {_select(WIDE)} FROM searches s LEFT JOIN ({ROLLUP_SQL}) i ON s.id = i.search_id LEFT JOIN ({TIMING_SQL}) t ON s.id = t.search_id LEFT JOIN positions p ON s.id = p.search_id
    LEFT JOIN engines e ON s.engine_id = e.id LEFT JOIN games g ON s.game_id = g.id LEFT JOIN suites u ON s.sts_id = u.id"""
_WIDE_DOUBLES = " ".join(k for k in WIDE if k.endswith(("_ratio", "_per_depth", "_ms", "_time", "nps", "_score")) and k != "game_score" or k == "qratio" or k in _ROLLUP_DOUBLES.split())


def _of_wide(sql: str) -> str:
    return f"WITH wide AS ({WIDE_SQL}) {sql}"


add("W01_W10_iteration_features", lambda iteration_rows: iteration_rows, ITERATION_SQL, _ITERATION_DOUBLES)
add("W10_tree_features", lambda tree_rows: tree_rows, TREE_SQL, " ".join(TREE))
add("A16_timing_pivot", lambda timings: search.pivoted_timings(timings), TIMING_SQL, " ".join(k for k in TIMING))
add("A17_A19_iteration_rollup", lambda iteration_rows: search.iteration_rollup(iteration_rows), ROLLUP_SQL, _ROLLUP_DOUBLES)
add("J01_J07_wide_features", lambda wide: wide, WIDE_SQL, _WIDE_DOUBLES)
#: Means of doubles, whose last digit depends on the order of rows, are left out.
_BY_ORDER = ["avg_eval", "stddev_eval"]
add(
    "J01_J07_by_bucket",
    wide_by_bucket,
    f"SELECT * EXCLUDE ({', '.join(_BY_ORDER)}) FROM ({WIDE_SQL}) AS w",
    " ".join(c for c in _WIDE_DOUBLES.split() if c not in _BY_ORDER),
)
add(
    "P14_incremental_iterations",
    lambda iterations: search.iteration_features(iterations, after=60),
    f"SELECT * FROM ({ITERATION_SQL}) AS q WHERE search_id > 60",
    _ITERATION_DOUBLES,
)

# projections, predicates, functions
add(
    "F01_F02_suite_parts",
    lambda suites: suites.select("id", safe.last_part("path").alias("suite"), safe.trimmed_part("category", "-", 2).alias("part2"), safe.trimmed_part("category", "-", 9).alias("part9")),
    "SELECT id, list_extract(string_split(path, '\\'), -1) AS suite, trim(split_part(category, '-', 2)) AS part2, trim(split_part(category, '-', 9)) AS part9 "
    "FROM suites",
)
_REASONS = {1: "checkmate", 2: "stalemate", 3: "repetition", 4: "fifty_moves", 5: "time", 6: "resign"}
add(
    "P05_decoded_termination",
    lambda games: games.select("id", safe.decoded("termination", _REASONS).alias("termination"), safe.decoded(F.lit("1-0"), _REASONS).alias("junk")),
    f"SELECT id, CASE termination {' '.join(f'WHEN {k} THEN {v!r}' for k, v in _REASONS.items())} END AS termination, CAST(NULL AS VARCHAR) AS junk "
    f"FROM games",
)
add(
    "P07_P08_guarded_ratios",
    lambda searches: searches.select("id", safe.guarded("nmp_failhigh", "nmp").alias("g"), safe.ratio("nmp_failhigh", "nmp").alias("r"), safe.ratio_not_one("nmp", "fh_index_3").alias("odd")),
    "SELECT id, CASE WHEN nmp > 0 THEN CAST(nmp_failhigh AS DOUBLE) / nmp END AS g, CAST(nmp_failhigh AS DOUBLE) / NULLIF(nmp, 0) AS r, CAST(nmp AS DOUBLE) / NULLIF(fh_index_3, 1) AS odd "
    "FROM searches",
    "g r odd",
)
add(
    "P15_P20_filters",
    lambda searches: searches.where(F.col("completed_depth").between(3, 12) & (F.abs("eval") <= 450) & (F.col("move") != "m2") & F.col("ply").isin(*range(0, 80, 3)) & ~F.col("engine_id").isin(1, 2) & ((F.col("nodes") < 300) | (F.col("qnodes") > 500))).select("id"),
    f"SELECT id FROM searches "
    f"WHERE completed_depth BETWEEN 3 AND 12 AND abs(eval) <= 450 AND move <> 'm2' AND ply IN ({','.join(map(str, range(0, 80, 3)))}) AND engine_id NOT IN (1, 2) AND (nodes < 300 OR qnodes > 500)",
)
add(
    "P22_P23_correctness",
    lambda conversations: match.correctness(conversations.select("conv_id", "turn", F.col("role").alias("move"), F.split("text", " ").alias("w")).select("*", F.slice("w", 1, 3).alias("expected"), F.array(F.lit("user")).alias("avoid")).select("conv_id", "turn", "move", F.when(F.col("turn") % 2 == 0, F.array(F.lit("x"), F.lit("user"), F.lit("assistant"))).otherwise(F.array().cast("array<string>")).alias("expected"), F.when(F.col("turn") % 3 == 0, F.col("avoid")).otherwise(F.array().cast("array<string>")).alias("avoid"))).select("conv_id", "turn", "stored_correct", "suite_correct"),
    "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role IN ('x', 'user') WHEN turn % 3 = 0 THEN role <> 'user' ELSE FALSE END AS stored_correct, CASE WHEN turn % 2 = 0 THEN role IN ('x', 'user', 'assistant') WHEN turn % 3 = 0 THEN role <> 'user' ELSE FALSE END AS suite_correct "
    "FROM conversations",
)
add(
    "P24a_threshold_labels",
    lambda events: events.select("event_id", match.phase_label(F.col("value") / 2000).alias("label")),
    "SELECT event_id, CASE WHEN value / 2000 > 0.1 THEN 'EXPLORING' WHEN value / 2000 > 0.05 THEN 'TUNING' WHEN value / 2000 > 0.01 THEN 'SETTLING' ELSE 'CONVERGED' END AS label "
    "FROM events",
)
add(
    "P25_crossfilter",
    lambda searches: views.crossfiltered(searches, {"eval": F.col("eval").between(-200, 200), "depth": F.col("depth") > 5, "engine": F.col("engine_id") == 3}, "depth").select("id"),
    "SELECT id FROM searches WHERE eval BETWEEN -200 AND 200 AND engine_id = 3",
)
add(
    "F09_move_rank",
    lambda searches: searches.select("id", search.move_rank(F.col("move"), F.col("sf_pv")).cast("int").alias("rank")),
    f"SELECT id, CAST(CASE WHEN move IS NULL OR sf_pv IS NULL THEN NULL {_RANKS.replace('s.', '')} WHEN json_array_length(sf_pv) > 0 THEN 0 END AS INTEGER) AS rank "
    f"FROM searches",
)
add(
    "F11_bounds_safe_index",
    lambda embeddings: embeddings.select("vec_id", safe.at_or_zero("embedding", 63).cast("double").alias("last"), safe.at_or_zero("embedding", 64).cast("double").alias("beyond")),
    "SELECT vec_id, CAST(embedding[64] AS DOUBLE) AS last, CAST(0 AS DOUBLE) AS beyond FROM embeddings",
    "last beyond",
)
add(
    "F12_F14_exploded_arrays",
    lambda embeddings: embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "v")).select("vec_id", (F.col("pos") + 1).alias("depth"), F.col("v").cast("double").alias("value")),
    "SELECT vec_id, CAST(unnest(range(1, 65)) AS INTEGER) AS depth, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings",
    "value",
)
add(
    "F15_exploded_map",
    lambda events: events.select("event_id", F.explode(F.from_json("props", "map<string,long>")).alias("name", "value")),
    "SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events",
)
add(
    "F17a_min_max_scaled",
    lambda events: events.select("event_id", match.scaled("value", Window.partitionBy("user_id")).alias("scaled")),
    "SELECT event_id, CASE WHEN max(value) OVER w > min(value) OVER w THEN (value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) ELSE 0.5 END AS scaled "
    "FROM events WINDOW w AS (PARTITION BY user_id)",
    "scaled",
)
add(
    "F18_half_even_cast",
    lambda orders: orders.select("o_orderkey", safe.half_even_int(F.col("o_orderkey") / 2).alias("h")),
    "SELECT o_orderkey, CAST(o_orderkey / 2 AS INTEGER) AS h FROM orders",
)

# joins, sets
add(
    "J08_ratings_with_engines",
    lambda records, engines: records.join(engines, F.col("engine_id") == F.col("id"), "left").select("engine_id", "name", "version", "wins"),
    "SELECT engine_id, name, version, CAST(wins AS BIGINT) AS wins FROM records LEFT JOIN engines ON engine_id = id",
)
add(
    "J10_unseen_positions",
    lambda searches, positions: searches.join(positions, F.col("id") == F.col("search_id"), "left_anti").select("id"),
    "SELECT id FROM searches WHERE id NOT IN (SELECT search_id FROM positions)",
)
add(
    "J11_orphans",
    lambda searches, engines: quality.orphans(searches, "engine_id", engines, "V01"),
    "SELECT 'V01' AS code, 'error' AS severity, count(*) AS n FROM searches WHERE engine_id NOT IN (SELECT id FROM engines)",
)
add(
    "J11_orphans_of_all",
    lambda searches, games, iterations, tree, timings, root_moves: quality.counted([
        quality.Source(games, parent=("game", "id")), quality.Source(searches, parent=("search", "id"), children={"search": ("game", "game_id")}),
        *[quality.Source(df, children={name: ("search", "search_id")}) for name, df in (("iteration", iterations), ("tree", tree), ("timing", timings), ("root_move", root_moves))],
    ]),
    "SELECT 'search' AS code, count(*) AS n FROM searches WHERE game_id NOT IN (SELECT id FROM games)"
    + "".join(f" UNION ALL SELECT '{code}', count(*) FROM {table} WHERE search_id NOT IN (SELECT id FROM searches)" for code, table in (("iteration", "iterations"), ("tree", "tree"), ("timing", "timings"), ("root_move", "root_moves"))),
)
_ENGINES = list(range(1, 23))
add("J14_aligned_by_depth", lambda searches: match.aligned(searches, "completed_depth", "engine_id", _ENGINES, "nodes"),
    "SELECT completed_depth, " + ", ".join(f'max(nodes) FILTER (engine_id = {k}) AS "{k}"' for k in _ENGINES) + " FROM searches GROUP BY completed_depth")
_DELTA = "32 * (wins + 0.5 * draws - (wins + draws + losses) / (1 + 10 ** (-(CAST(engine_id % 100 AS DOUBLE) - (engine_id + 1) % 100) / 400)))"
add(
    "J16_A33_elo_deltas",
    lambda records: match.elo_deltas(match.paired_results(records)),
    f"SELECT name, sum(d) AS delta FROM (SELECT engine_id AS name, {_DELTA} AS d FROM records "
    f"UNION ALL SELECT engine_id + 1, -({_DELTA}) FROM records) AS x GROUP BY name",
    "delta",
)
add(
    "O01_unpivoted_buckets",
    lambda searched: views.fail_high_distribution(searched),
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{b}' AS bucket, CAST(sum(fh_index_{b}) AS DOUBLE) / NULLIF(sum(fail_highs), 0) AS ratio, {k} AS ord FROM searches WHERE fh_index_0 IS NOT NULL" for k, b in enumerate(FH_BUCKETS)) + ") AS x",
    "ratio",
)
add(
    "O02_W17_first_and_last_engines",
    lambda engines: match.first_and_last(engines, 3).select("id"),
    "SELECT id FROM engines WHERE id IN (SELECT id FROM engines ORDER BY id DESC LIMIT 3) OR id IN (SELECT min(id) FROM engines)",
)
add(
    "O06_missing_keys",
    lambda searches, suites: searches.select(F.col("sts_id").alias("id")).distinct().join(suites, "id", "left_anti"),
    "SELECT DISTINCT sts_id AS id FROM searches WHERE sts_id NOT IN (SELECT id FROM suites)",
)
_SAMPLE = "ORDER BY md5('42|' || CAST(search_id AS VARCHAR)), search_id LIMIT"
add(
    "T05_hash_sample",
    lambda searched: views.eval_scatter(searched, 50).select("search_id"),
    f"SELECT id AS search_id FROM searches WHERE abs(eval) < 1000 AND abs(sf_eval) < 1000 {_SAMPLE} 50",
)
add(
    "T03_latest_by_engine",
    lambda searches: searches.groupBy("engine_id").agg(F.max("id").alias("id"), F.max_by("eval", "id").alias("eval")),
    "SELECT engine_id, max(id) AS id, arg_max_null(eval, id) AS eval FROM searches GROUP BY engine_id",
)

# aggregates
add(
    "A05_duplicate_keys",
    lambda searches: searches.agg(quality.duplicates(searches, ["game_id", "ply", "fen", "move"]).alias("n")),
    "SELECT count(*) - count(DISTINCT CAST(game_id AS VARCHAR) || '|' || CAST(ply AS VARCHAR) || '|' || fen || '|' || move) AS n FROM searches",
)
add(
    "A21_fail_high_shares",
    lambda searched: views.fail_high_shares(searched),
    "SELECT count(*) AS n, " + ", ".join(f"100.0 * sum(fh_index_{b}) / NULLIF({' + '.join(f'coalesce(sum(fh_index_{x}), 0)' for x in FH_BUCKETS)}, 0) AS \"share_{b}\"" for b in FH_BUCKETS) + " FROM searches WHERE fh_index_0 IS NOT NULL",
    " ".join(f"share_{b}" for b in FH_BUCKETS),
)
add(
    "A26_A27_against_baseline",
    lambda searches: match.against_baseline(searches, "engine_id", 1, "nodes"),
    "WITH m AS (SELECT engine_id, avg(nodes) AS mean FROM searches GROUP BY engine_id), b AS (SELECT mean AS base FROM m "
    "WHERE engine_id = 1) SELECT engine_id, mean, mean - base AS delta, 100 * (mean - base) / NULLIF(base, 0) AS percent, CASE WHEN 100 * (mean - base) / NULLIF(base, 0) > 0.1 THEN 'up' WHEN 100 * (mean - base) / NULLIF(base, 0) < -0.1 THEN 'down' ELSE 'same' END AS direction "
    "FROM m, b",
    "mean delta percent",
)
add(
    "A28_suite_accuracy",
    lambda suites: match.suite_accuracy(suites),
    "SELECT split_part(category, ' - ', 1) AS category, count(*) AS n, count(*) FILTER (move_is_correct) AS correct, avg(abs(engine_score - expected_score)) AS mean_difference "
    "FROM suites GROUP BY 1 "
    "UNION ALL SELECT NULL, count(*), count(*) FILTER (move_is_correct), avg(abs(engine_score - expected_score)) FROM suites",
    "mean_difference",
)
_PAIRS = "SELECT run, (game_num - 1) // 2 AS pair, CASE WHEN min(outcome) > max(outcome) THEN '' ELSE string_agg(outcome, '' ORDER BY outcome) END AS kind FROM played GROUP BY 1, 2 HAVING count(*) = 2"
add("A29_W14_game_pairs", lambda played: match.game_pairs(played, "run"), f"SELECT run, kind, count(*) AS n FROM ({_PAIRS}) AS p GROUP BY run, kind")
add(
    "A30_pair_scores",
    lambda played: match.pair_scores(played, "run"),
    f"SELECT run, count(*) AS pairs, sum(CASE kind WHEN 'ww' THEN 2 WHEN 'dw' THEN 1.5 WHEN 'lw' THEN 1 WHEN 'dd' THEN 1 WHEN 'dl' THEN 0.5 ELSE 0 END) / (2 * count(*)) AS score "
    f"FROM ({_PAIRS}) AS p GROUP BY run",
    "score",
)
add(
    "A32_U22_pool_elo",
    lambda records: match.pool_rating(records, F.lit(1500.0) + F.col("engine_id") % 100),
    "SELECT round(sum(r * n) / sum(n), 1) AS rating, CAST(sum(n) AS BIGINT) AS games "
    "FROM (SELECT wins + draws + losses AS n, 1500.0 + engine_id % 100 + CASE WHEN s <= 0 THEN -800.0 WHEN s >= 1 THEN 800.0 ELSE round(-400 * log10(1 / s - 1), 1) END AS r "
    "FROM (SELECT *, (wins + 0.5 * draws) / (wins + draws + losses) AS s FROM records) AS a) AS b",
    "rating",
)
add(
    "A34_U27_paired_summary",
    lambda events: match.paired_summary(events.where("event_type = 'view'").groupBy("user_id").agg(F.avg("value").alias("a")).join(events.where("event_type = 'click'").groupBy("user_id").agg(F.avg("value").alias("b")), "user_id"), "a", "b"),
    "SELECT count(x) AS n, avg(x) AS mean, stddev_samp(x) AS sd, coalesce(avg(x) / NULLIF(stddev_samp(x), 0), 0) AS cohen_d "
    "FROM (SELECT avg(value) FILTER (event_type = 'view') - avg(value) FILTER (event_type = 'click') AS x FROM events "
    "GROUP BY user_id) AS d",
    "mean sd cohen_d",
)

# windows over runs
add(
    "W11_branching_factor",
    lambda iteration_rows: match.effective_branching(iteration_rows),
    f"SELECT search_id, depth, cumulative_ms, sqrt(CAST(total_nodes AS DOUBLE) / NULLIF(n2, 0)) AS ebf2 "
    f"FROM (SELECT search_id, depth, nodes + qnodes AS total_nodes, sum(time_ms) OVER {_W} AS cumulative_ms, lag(nodes + qnodes, 2) OVER {_W} AS n2, row_number() OVER (PARTITION BY search_id "
    f"ORDER BY depth DESC) AS r FROM iterations) AS q WHERE r > 1",
    "cumulative_ms ebf2",
)
add(
    "W12_W18_trailing_means",
    lambda iterations: match.trailing(iterations),
    f"SELECT search_id, depth, avg(time_ms) OVER (PARTITION BY search_id "
    f"ORDER BY depth ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS trailing, avg(CASE WHEN nodes > qnodes THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY search_id "
    f"ORDER BY depth ROWS UNBOUNDED PRECEDING) AS win_rate FROM iterations",
    "trailing win_rate",
)
add(
    "W13_smoothed",
    lambda iterations: match.smoothed(iterations, "search_id", "depth", "time_ms"),
    "SELECT search_id, unnest(list_transform(s, lambda x: x.o)) AS depth, unnest(list_transform(range(1, len(s) + 1), lambda i: list_reduce(list_transform(s[1:i], lambda y: y.v), lambda a, b: 0.8 * a + 0.2 * b))) AS ema "
    "FROM (SELECT search_id, list({'o': depth, 'v': time_ms} ORDER BY depth) AS s FROM iterations GROUP BY search_id) AS q",
    "ema",
)
_LLR = "sw + 0.5 AS w, sd + 0.5 AS d, sl + 0.5 AS l, sw + sd + sl + 1.5 AS n"
_LLR_SQL = """SELECT {keys}, w * ln(p1w / p0w) + l * ln(p1l / p0l) + d * ln((1 - p1w - p1l) / (1 - p0w - p0l)) AS llr FROM (
  SELECT *, 1 / (1 + 10 ** ((dr - 0 / s) / 400)) AS p0w, 1 / (1 + 10 ** ((dr + 0 / s) / 400)) AS p0l, 1 / (1 + 10 ** ((dr - 10 / s) / 400)) AS p1w, 1 / (1 + 10 ** ((dr + 10 / s) / 400)) AS p1l FROM (
  SELECT *, 4 * x / ((1 + x) * (1 + x)) AS s FROM (SELECT *, 10 ** (-dr / 400) AS x FROM (SELECT *, 200 * log10((1 - l / n) / (l / n) * (1 - w / n) / (w / n)) AS dr FROM ({source}) AS a) AS b) AS c) AS e) AS f"""
_RUNNING = f"SELECT run, game_num, {_LLR} FROM (SELECT run, game_num, sum(CASE outcome WHEN 'w' THEN 1 ELSE 0 END) OVER o AS sw, sum(CASE outcome WHEN 'd' THEN 1 ELSE 0 END) OVER o AS sd, sum(CASE outcome WHEN 'l' THEN 1 ELSE 0 END) OVER o AS sl FROM played WINDOW o AS (PARTITION BY run ORDER BY game_num)) AS z"
add(
    "W15_running_llr",
    lambda played: match.running_test(played, "run").select("run", "game_num", "llr"),
    _LLR_SQL.format(keys="run, game_num", source=_RUNNING),
    "llr",
)

# ratings
_REC = "SELECT engine_id, wins AS sw, draws AS sd, losses AS sl, wins + draws + losses AS k FROM records"
add(
    "U13_U15_elo",
    lambda records: records.select("engine_id", elo.score_to_elo(elo.match_score(F.col("wins"), F.col("draws"), F.col("losses"))).alias("elo"), elo.naive_elo(F.col("wins"), F.col("losses")).alias("naive"), elo.elo_to_score(F.col("wins") * 10.0).alias("expected")),
    f"SELECT engine_id, CASE WHEN s <= 0 THEN 0 WHEN s >= 1 THEN 800 ELSE -400 * log10(1 / s - 1) END AS elo, CASE WHEN sw = 0 OR sl = 0 THEN 0 ELSE 400 * log10(CAST(sw AS DOUBLE) / sl) END AS naive, 1 / (1 + 10 ** (-sw * 10 / 400.0)) AS expected "
    f"FROM (SELECT *, (sw + sd / 2.0) / k AS s FROM ({_REC}) AS r) AS q",
    "elo naive expected",
)
add(
    "U16_U19_llr_decision",
    lambda records: match.decided(records),
    f"SELECT engine_id, llr, CASE WHEN llr >= ln(0.95 / 0.05) THEN 'pass' WHEN llr <= ln(0.05 / 0.95) THEN 'fail' ELSE 'inconclusive' END AS decision "
    f"FROM ({_LLR_SQL.format(keys='engine_id', source=f'SELECT engine_id, {_LLR} FROM ({_REC}) AS r')}) AS y",
    "llr",
)
_Z = "1.959963984540054"
_CLAMP = lambda sign: f"(CASE WHEN q <= 0 THEN 0 WHEN q >= 1 THEN 800 ELSE -400 * log10(1 / q - 1) END)".replace("q", f"({'greatest(0.001, s - ci)' if sign < 0 else 'least(0.999, s + ci)'})")
add(
    "U17_elo_interval",
    lambda records: records.select("engine_id", elo.elo_interval(F.col("wins"), F.col("draws"), F.col("losses")).alias("x")).select("engine_id", "x.*"),
    f"SELECT engine_id, elo, CASE WHEN v <= 0 THEN elo ELSE {_CLAMP(-1)} END AS low, CASE WHEN v <= 0 THEN elo ELSE {_CLAMP(1)} END AS high "
    f"FROM (SELECT *, {_Z} * sqrt(greatest(v, 0)) AS ci, CASE WHEN s <= 0 THEN 0 WHEN s >= 1 THEN 800 ELSE -400 * log10(1 / s - 1) END AS elo "
    f"FROM (SELECT *, ((sw + sd / 4.0) / k - s * s) / k AS v FROM (SELECT *, (sw + sd / 2.0) / k AS s "
    f"FROM ({_REC}) AS r) AS a) AS b) AS c",
    "elo low high",
)
_ELO = lambda q: f"(CASE WHEN {q} <= 0 THEN 0 WHEN {q} >= 1 THEN 800 ELSE -400 * log10(1 / ({q}) - 1) END)"
add(
    "U17_other_intervals",
    lambda records: records.select("engine_id", elo.bayes_elo_interval(F.col("wins"), F.col("draws"), F.col("losses")).alias("b"), elo.normalized_elo_interval(F.col("wins"), F.col("draws"), F.col("losses")).alias("n")).select("engine_id", F.col("b.elo").alias("bayes"), F.col("b.low").alias("bayes_low"), F.col("b.high").alias("bayes_high"), F.col("n.elo").alias("normalized"), F.col("n.low").alias("normalized_low"), F.col("n.high").alias("normalized_high")),
    f"""SELECT engine_id, be * sc AS bayes, {_ELO('greatest(0.001, bm - bci)')} * sc AS bayes_low, {_ELO('least(0.999, bm + bci)')} * sc AS bayes_high,
    CASE WHEN m <= 0 OR m >= 1 THEN 0 ELSE {_ELO('m')} * ns END AS normalized, CASE WHEN m <= 0 OR m >= 1 THEN 0 WHEN v <= 0 THEN {_ELO('m')} * ns ELSE {_ELO('greatest(0.001, m - ci)')} * ns END AS normalized_low,
    CASE WHEN m <= 0 OR m >= 1 THEN 0 WHEN v <= 0 THEN {_ELO('m')} * ns ELSE {_ELO('least(0.999, m + ci)')} * ns END AS normalized_high FROM (
    SELECT *, 4 * x / ((1 + x) * (1 + x)) AS sc, {_Z} * sqrt(((w + d / 4) / n - bm * bm) / n) AS bci, {_Z} * sqrt(greatest(v, 0)) AS ci, CASE WHEN pv > 0 THEN sqrt(0.25 / pv) ELSE 1 END AS ns FROM (
    SELECT *, 10 ** (-dr / 400) AS x, ((sw + sd / 4.0) / k - m * m) / k AS v, (sw * (1 - m) * (1 - m) + sd * (0.5 - m) * (0.5 - m) + sl * m * m) / k AS pv FROM (
    SELECT *, (w + d / 2) / n AS bm, (sw + sd / 2.0) / k AS m, 200 * log10((w / (n - w)) / (l / (n - l))) AS be, -200 * log10((w / (n - w)) * (l / (n - l))) AS dr FROM (
    SELECT *, {_LLR} FROM ({_REC}) AS r) AS a) AS b) AS c) AS e""",
    "bayes bayes_low bayes_high normalized normalized_low normalized_high",
)
_CDF = lambda z: f"""CASE WHEN {z} > 8 THEN 1.0 WHEN {z} < -8 THEN 0.0 ELSE 0.5 + exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_reduce(range(1, 151),
    lambda a, k: {{'term': a.term * ({z}) * ({z}) / (2 * k + 1), 'sum': a.sum + a.term * ({z}) * ({z}) / (2 * k + 1)}}, {{'term': CAST({z} AS DOUBLE), 'sum': CAST({z} AS DOUBLE)}}).sum END"""  # noqa: E731
add(
    "U18_superiority",
    lambda records: records.select("engine_id", elo.likelihood_of_superiority(F.col("wins"), F.col("losses")).alias("x")).select("engine_id", "x.*"),
    f"""SELECT engine_id, CASE WHEN n = 0 THEN 50.0 ELSE 100 * ({_CDF('z')}) END AS los, CASE WHEN n = 0 THEN 0.0 ELSE 100 * ({_CDF('(z - 1.96)')}) END AS low, CASE WHEN n = 0 THEN 100.0 ELSE 100 * ({_CDF('(z + 1.96)')}) END AS high
    FROM (SELECT engine_id, sw + sl AS n, coalesce((sw - sl) / sqrt(2.0 * NULLIF(sw + sl, 0)), 0) AS z FROM ({_REC}) AS r) AS q""",
    "los low high",
)
add(
    "U20_elo_difference",
    lambda records: records.select("engine_id", elo.elo_difference(F.col("wins"), F.col("losses"), F.col("draws")).alias("elo")),
    "SELECT engine_id, CASE WHEN s <= 0 THEN -800.0 WHEN s >= 1 THEN 800.0 ELSE round(-400 * log10(1 / s - 1), 1) END AS elo "
    "FROM (SELECT engine_id, (wins + 0.5 * draws) / (wins + draws + losses) AS s FROM records) AS q",
    "elo",
)
_SOLVED = "list_reduce(range(1, 101), lambda b, k: CASE WHEN list_sum(list_transform(met, lambda o: o.n / (1 + pow(10, (o.elo - (b.low + b.high) / 2) / 400)))) < points THEN {'low': (b.low + b.high) / 2, 'high': b.high} ELSE {'low': b.low, 'high': (b.low + b.high) / 2} END, {'low': CAST(-1000 AS DOUBLE), 'high': CAST(5000 AS DOUBLE)})"
add(
    "U21_performance_rating",
    lambda records: match.performance_ratings(records.select((F.col("engine_id") % 40).alias("candidate"), "wins", "draws", "losses", (1400.0 + F.col("engine_id") % 300).alias("opponent_elo"))),
    f"""SELECT candidate, round(CASE WHEN points >= games THEN mean + 800 WHEN points <= 0 THEN mean - 800 ELSE (solved.low + solved.high) / 2 END, 1) AS rating, games FROM (SELECT *, {_SOLVED} AS solved FROM (
    SELECT candidate, CAST(sum(n) AS BIGINT) AS games, sum(points) AS points, sum(elo * n) / sum(n) AS mean, list({{'elo': elo, 'n': n}} ORDER BY elo) AS met FROM (
    SELECT engine_id % 40 AS candidate, CAST(1400 + engine_id % 300 AS DOUBLE) AS elo, CAST(sum(wins + draws + losses) AS DOUBLE) AS n, CAST(sum(wins + 0.5 * draws) AS DOUBLE) AS points FROM records WHERE wins + draws + losses > 0 GROUP BY 1, 2) AS a GROUP BY 1) AS b) AS c""",
    "rating",
)
add(
    "U23_time_controls",
    lambda orders: orders.select("o_orderkey", elo.time_control_class(F.when(F.col("o_orderkey") % 2 == 0, F.concat((F.col("o_orderkey") % 37).cast("string"), F.lit(":30+1"))).otherwise(F.concat((F.col("o_orderkey") % 90).cast("string"), F.lit("+0.1")))).alias("tc")),
    "SELECT o_orderkey, CASE WHEN m < 0.25 THEN 'ultra_fast' WHEN m < 2 THEN 'bullet' WHEN m < 10 THEN 'blitz' WHEN m < 30 THEN 'rapid' ELSE 'classical' END AS tc "
    "FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 37 * 60 + 30 + 40) / 60.0 ELSE (o_orderkey % 90 + 4) / 60.0 END AS m "
    "FROM orders) AS q",
)
add(
    "U24_rating_lookup",
    lambda engines, records: match.looked_up(engines, records.where("wins > losses").select("engine_id", (F.col("wins") * 3.0).alias("elo"))),
    "SELECT id, coalesce(wins * 3.0, 1500) AS elo FROM engines LEFT JOIN (SELECT * FROM records WHERE wins > losses) AS r ON engine_id = id",
    "elo",
)
add(
    "U30_match_score",
    lambda records: records.select("engine_id", elo.match_score(F.col("wins"), F.col("draws"), F.col("losses")).alias("score")),
    "SELECT engine_id, (wins + draws / 2.0) / (wins + draws + losses) AS score FROM records",
    "score",
)

# quality
_V = lambda code, severity, source, rule: f"SELECT '{code}' AS code, '{severity}' AS severity, count(*) AS n FROM {source} WHERE {rule}"
_CHECKS = [
    _V("V01", "error", "searches", "engine_id NOT IN (SELECT id FROM engines)"), _V("V02", "error", "searches", "nodes < 0 OR qnodes < 0"), _V("V03", "warn", "searches", "qnodes > nodes + qnodes"), _V("V04", "error", "searches", "time_ms < 0"),
    _V("V05", "warn", "searches", "completed_depth <= 0 OR completed_depth > 100"), _V("V06", "warn", "searches", "time_ms > 0 AND (nodes + qnodes) / (time_ms / 1000) > 1e9"), _V("V07", "warn", "searches", "eval IS NULL AND completed_depth > 3"),
    "SELECT 'V08' AS code, 'warn' AS severity, CASE WHEN d > 100 THEN d ELSE 0 END AS n FROM (SELECT count(*) - count(DISTINCT CAST(game_id AS VARCHAR) || '|' || CAST(ply AS VARCHAR) || '|' || fen || '|' || CAST(engine_id AS VARCHAR)) AS d FROM searches) AS q",
    _V("V09", "error", "iterations", "search_id NOT IN (SELECT id FROM searches)"), _V("V10", "warn", "iterations", "depth <= 0"), _V("V11", "error", "iterations", "nodes < 0 OR qnodes < 0"),
    _V("V12", "warn", "games", "result NOT IN ('white', 'black', 'draw')"), _V("V13", "error", "games", "run_time_s < 0"), _V("V14", "error", "tree", "search_id NOT IN (SELECT id FROM searches)"),
    *[_V(f"V15_{r}", "warn", "wide", f"{r} < -0.01 OR {r} > 1.01") for r in quality.RATIOS], _V("V16", "warn", "wide", "avg_ebf < 0"), _V("V17", "error", "timings", "total_time_ms < 0"), _V("V18", "error", "timings", "num_calls < 0"),
]
add(
    "V01_V18_quality_report",
    lambda searches, engines, iterations, tree, games, timings: quality.report(searches, engines, iterations, tree, games, timings),
    _of_wide(" UNION ALL ".join(_CHECKS)),
)
add(
    "V19_quality_verdict",
    lambda searches, engines, iterations, tree, games, timings: quality.passed(quality.report(searches, engines, iterations, tree, games, timings)),
    _of_wide(f"SELECT count(*) FILTER (severity = 'error' AND n > 0) = 0 AS passed, count(*) FILTER (severity = 'error' AND n > 0) AS errors, count(*) FILTER (severity = 'warn' AND n > 0) AS warnings FROM ({' UNION ALL '.join(_CHECKS)}) AS c"),
)

# report views
add(
    "D01_overview_counts",
    lambda engines, games, searches: engines.agg(F.count("*").alias("engines"), F.lit(1).alias("o")).join(games.agg(F.count("*").alias("games"), F.lit(1).alias("o")), "o").join(searches.agg(F.count("*").alias("searches"), F.lit(1).alias("o")), "o").drop("o"),
    "SELECT (SELECT count(*) FROM engines) AS engines, (SELECT count(*) FROM games) AS games, (SELECT count(*) FROM searches) AS searches",
)
add(
    "D02_overview_summary",
    lambda searched: views.overview_summary(searched),
    "SELECT avg(depth) AS avg_depth, max(depth) AS max_depth, avg(eval) AS avg_eval, avg(nodes + qnodes) AS avg_nodes, avg(time_ms) AS avg_time "
    "FROM searches",
    "avg_depth avg_eval avg_nodes avg_time",
)
_OVERVIEW = [
    ("eval", "eval", 100, "abs(eval) <= 1500"), ("total_nodes", "(nodes + qnodes)", 200, "nodes + qnodes > 0"), ("depth", "depth", 4, "true"), ("total_time_ms", "time_ms", 250, "true"), ("tt_hits", "tt_hits", 5, "true"),
    ("nps", f"({_n('(nodes + qnodes)', '(time_ms / 1000)')})", 500, "true"), ("qratio", f"({_n('qnodes', '(nodes + qnodes)')})", 0.125, "true"),
]
for _m, _sql, _step, _rule in _OVERVIEW:
    add(
        f"D03_histogram_{_m}",
        lambda searched, _m=_m, _step=_step: views.overview_histogram(searched, _m, _step),
        f"SELECT floor({_sql} / CAST({_step} AS DOUBLE)) * {_step} AS bin, count(*) AS count FROM searches "
        f"WHERE {_rule} AND {_sql} IS NOT NULL GROUP BY 1",
        "bin",
    )
add(
    "D04_engine_counts",
    lambda searched: views.counted(searched, "engine_id", "engine_id"),
    "SELECT engine_id, count(*) AS count FROM searches GROUP BY engine_id",
)
add(
    "D05_search_summary",
    lambda searched: views.search_summary(searched),
    f"SELECT count(*) AS total, avg(depth) AS avg_depth, avg(nodes + qnodes) AS avg_nodes, avg({_n('(nodes + qnodes)', '(time_ms / 1000)')}) AS avg_nps, avg(time_ms) AS avg_time, avg({_n('tt_hits', '(nodes + qnodes)')}) AS avg_tt_hit_ratio "
    f"FROM searches",
    "avg_depth avg_nodes avg_nps avg_time avg_tt_hit_ratio",
)
add(
    "D06_linked_histogram",
    lambda searched: views.histogram(views.crossfiltered(searched, {"eval": F.col("eval") > 0, "depth": F.col("depth") < 20}, "eval"), "eval", 100),
    "SELECT floor(eval / 100.0) * 100 AS bin, count(*) AS count FROM searches WHERE depth < 20 AND eval IS NOT NULL GROUP BY 1",
    "bin",
)
add(
    "D07_game_results",
    lambda games: views.game_results(games),
    "SELECT count(*) AS total, count(*) FILTER (result = 'white') AS white_wins, count(*) FILTER (result = 'black') AS black_wins, count(*) FILTER (result = 'draw') AS draws, avg(run_time_s) AS avg_time, count(DISTINCT opening) AS n_openings "
    "FROM games",
    "avg_time",
)
add(
    "D08_game_time_histogram",
    lambda games: views.histogram(games, "run_time_s", 1000, by="result"),
    "SELECT floor(run_time_s / 1000) * 1000 AS bin, result, count(*) AS count FROM games WHERE run_time_s IS NOT NULL GROUP BY 1, 2",
    "bin",
)
add(
    "D09_top_openings",
    lambda games: views.counted(games, "opening", "opening", 20),
    "SELECT opening, count(*) AS count FROM games GROUP BY opening ORDER BY count DESC, opening NULLS LAST LIMIT 20",
)
add(
    "D10_openings_summary",
    lambda games: views.openings_summary(games),
    "SELECT count(*) AS total_games, count(DISTINCT opening) AS n_openings, count(DISTINCT opening_eco) AS n_eco FROM games WHERE opening <> ''",
)
add(
    "D11_opening_frequency",
    lambda games: views.counted(games.where(views.filled("opening")), "opening", "opening", 25),
    "SELECT opening, count(*) AS count FROM games WHERE opening <> '' GROUP BY opening ORDER BY count DESC, opening LIMIT 25",
)
add(
    "D12_opening_win_rate",
    lambda games: views.opening_win_rate(games),
    "SELECT opening, count(*) AS games, avg(CASE result WHEN 'white' THEN 1.0 WHEN 'draw' THEN 0.5 ELSE 0 END) AS white_score "
    "FROM games WHERE opening <> '' GROUP BY opening HAVING count(*) >= 3 ORDER BY white_score DESC, opening LIMIT 25",
    "white_score",
)
add(
    "D13_opening_depth",
    lambda searched_openings: views.opening_depth(searched_openings),
    "SELECT g.opening AS opening, avg(s.completed_depth) AS avg_depth, count(*) AS n FROM searches s JOIN games g ON s.game_id = g.id "
    "WHERE g.opening <> '' GROUP BY 1 HAVING count(*) >= 5 ORDER BY avg_depth DESC, opening LIMIT 25",
    "avg_depth",
)
add(
    "D14_eco_letters",
    lambda games: views.eco_letters(games),
    "SELECT substring(opening_eco, 1, 1) AS eco_letter, count(*) AS count FROM games WHERE opening_eco <> '' GROUP BY 1",
)
add("D15_engine_labels", lambda engines: views.engine_labels(engines), "SELECT id, name, version, name || ' (' || version || ')' AS label FROM engines")
add(
    "D15_engine_trend",
    lambda searched, engines: views.engine_trend(searched, engines),
    "SELECT e.id AS id, e.name || ' (' || e.version || ')' AS engine_label, avg(completed_depth) AS avg_depth, avg(nodes + qnodes) AS avg_nodes, avg(time_ms) AS avg_time_ms, avg(tt_hits) AS avg_tt_hits, avg(fail_highs) AS avg_fail_highs, avg(nmp) AS avg_nmp, count(*) AS n_searches "
    "FROM searches s JOIN engines e ON s.engine_id = e.id GROUP BY e.id, e.name, e.version",
    "avg_depth avg_nodes avg_time_ms avg_tt_hits avg_fail_highs avg_nmp",
)
add(
    "D16_histogram_by_engine",
    lambda searched_by_name: views.histogram(searched_by_name, "eval", 200, by="engine_name"),
    "SELECT floor(eval / 200.0) * 200 AS bin, e.name AS engine_name, count(*) AS count FROM searches s LEFT "
    "JOIN engines e ON s.engine_id = e.id WHERE eval IS NOT NULL GROUP BY 1, 2",
    "bin",
)
add(
    "D17_iteration_means",
    lambda iteration_rows: views.averaged(iteration_rows, "depth", "time_ms", "eval", "fail_highs", "nodes", "qratio"),
    f"SELECT depth, avg(time_ms) AS time_ms, avg(eval) AS eval, avg(fail_highs) AS fail_highs, avg(nodes) AS nodes, avg({_n('qnodes', '(nodes + qnodes)')}) AS qratio "
    f"FROM iterations GROUP BY depth",
    "time_ms eval fail_highs nodes qratio",
)
add(
    "D18_tree_means",
    lambda tree_rows: views.averaged(tree_rows, "depth", "nodes", "qnodes", "fail_highs", "fail_lows"),
    "SELECT depth, avg(nodes) AS nodes, avg(qnodes) AS qnodes, avg(fail_highs) AS fail_highs, avg(fail_lows) AS fail_lows FROM tree GROUP BY depth",
    "nodes qnodes fail_highs fail_lows",
)
add(
    "D19_pruning_summary",
    lambda searched: views.pruning_summary(searched),
    f"SELECT count(*) AS total, avg(see_prunes) AS avg_see, avg(delta_prunes) AS avg_delta, avg(nmp) AS avg_nmp, avg(nmp_failhigh) AS avg_nmp_failhigh, avg({_n('nmp', '(nodes + qnodes)')}) AS avg_nmp_ratio, avg(CASE WHEN nmp > 0 THEN CAST(nmp_failhigh AS DOUBLE) / nmp END) AS avg_nmp_failhigh_rate "
    f"FROM searches",
    "avg_see avg_delta avg_nmp avg_nmp_failhigh avg_nmp_ratio avg_nmp_failhigh_rate",
)
add(
    "D20_pruning_by_depth",
    lambda searched: views.pruning_by_depth(searched),
    f"SELECT completed_depth AS depth, avg({_n('see_prunes', '(nodes + qnodes)')}) AS see_ratio, avg({_n('delta_prunes', '(nodes + qnodes)')}) AS delta_ratio, avg({_n('nmp', '(nodes + qnodes)')}) AS nmp_ratio "
    f"FROM searches WHERE completed_depth BETWEEN 1 AND 30 GROUP BY 1",
    "see_ratio delta_ratio nmp_ratio",
)
add(
    "D21_nmp_fail_rates",
    lambda searched: views.nmp_fail_rates(searched, 0.25),
    "SELECT floor(CAST(nmp_failhigh AS DOUBLE) / nmp / 0.25) * 0.25 AS bin, count(*) AS count FROM searches "
    "WHERE nmp > 0 AND nmp_failhigh IS NOT NULL GROUP BY 1",
    "bin",
)
add(
    "D22_prunes_by_depth",
    lambda iteration_rows: views.averaged(iteration_rows, "depth", "see_prunes", "delta_prunes"),
    "SELECT depth, avg(see_prunes) AS see_prunes, avg(delta_prunes) AS delta_prunes FROM iterations GROUP BY depth",
    "see_prunes delta_prunes",
)
add(
    "D23_pruning_by_engine",
    lambda searched, engines: views.pruning_by_engine(searched, engines),
    f"SELECT e.id AS id, e.name || ' (' || e.version || ')' AS engine_label, avg({_n('see_prunes', '(nodes + qnodes)')}) AS see_ratio, avg({_n('delta_prunes', '(nodes + qnodes)')}) AS delta_ratio, avg({_n('nmp', '(nodes + qnodes)')}) AS nmp_ratio, avg(CASE WHEN nmp > 0 THEN CAST(nmp_failhigh AS DOUBLE) / nmp END) AS nmp_failhigh_rate "
    f"FROM searches s JOIN engines e ON s.engine_id = e.id GROUP BY e.id, e.name, e.version",
    "see_ratio delta_ratio nmp_ratio nmp_failhigh_rate",
)
_FH = ", ".join(f"avg(fh_index_{b}_ratio) AS idx{b}" for b in FH_BUCKETS)
_FHD = " ".join(f"idx{b}" for b in FH_BUCKETS)
add(
    "D26_fail_high_by_iteration",
    lambda iteration_rows: views.fail_high_by_depth(iteration_rows, "depth", 25),
    f"SELECT depth, {_FH} FROM ({ITERATION_SQL}) AS f WHERE fh_index_0_ratio IS NOT NULL AND depth BETWEEN 1 AND 25 GROUP BY depth",
    _FHD,
)
add(
    "D26_fail_high_by_ply",
    lambda tree_rows: views.fail_high_by_depth(tree_rows, "depth", 30, "ply"),
    f"SELECT depth AS ply, {_FH} FROM ({TREE_SQL}) AS f WHERE fh_index_0_ratio IS NOT NULL AND depth BETWEEN 1 AND 30 GROUP BY depth",
    _FHD,
)
add(
    "D27_fail_high_by_engine",
    lambda searched_by_name: views.fail_high_by_engine(searched_by_name),
    "SELECT e.name AS engine_name, " + ", ".join(f"CAST(sum(fh_index_{b}) AS DOUBLE) / NULLIF(sum(fail_highs), 0) AS idx{b}_ratio" for b in FH_BUCKETS) + " FROM searches s LEFT JOIN engines e ON s.engine_id = e.id WHERE fh_index_0 IS NOT NULL GROUP BY 1",
    " ".join(f"idx{b}_ratio" for b in FH_BUCKETS),
)
add(
    "D29_phases",
    lambda searched_positions: views.phase_summary(searched_positions),
    f"SELECT game_phase, count(*) AS count, avg(completed_depth) AS avg_depth, avg({_n('(nodes + qnodes)', '(time_ms / 1000)')}) AS avg_nps "
    f"FROM searches s JOIN positions p ON s.id = p.search_id GROUP BY game_phase",
    "avg_depth avg_nps",
)
add(
    "D29_types",
    lambda searched_positions: views.counted(searched_positions.where(views.filled("position_type")), "position_type", "position_type"),
    "SELECT position_type, count(*) AS count FROM positions WHERE position_type <> '' GROUP BY 1",
)
add(
    "D30_accuracy_by_phase",
    lambda searched_positions: views.accuracy_by_phase(searched_positions),
    "SELECT game_phase, avg(CASE WHEN move = sf_best_move THEN 1.0 ELSE 0 END) AS match_rate, avg(abs(eval - sf_eval)) AS mae, count(*) AS n "
    "FROM searches s JOIN positions p ON s.id = p.search_id WHERE eval IS NOT NULL AND sf_eval IS NOT NULL GROUP BY 1",
    "match_rate mae",
)
add(
    "D31_depth_by_type",
    lambda searched_positions: views.depth_by_type(searched_positions),
    "SELECT position_type, avg(completed_depth) AS avg_depth, count(*) AS n FROM searches s JOIN positions p ON s.id = p.search_id "
    "WHERE position_type <> '' GROUP BY 1 HAVING count(*) >= 5",
    "avg_depth",
)
add(
    "D32_tactical_sample",
    lambda searched_positions: safe.sample_rows(searched_positions.where("position_tactical_score IS NOT NULL").select("search_id", "position_tactical_score", "position_positional_score"), ["search_id"], 100),
    f"SELECT search_id, pos_tactical AS position_tactical_score, pos_positional AS position_positional_score FROM positions "
    f"WHERE pos_tactical IS NOT NULL {_SAMPLE} 100",
    "position_tactical_score position_positional_score",
)
add(
    "D33_timing_summary",
    lambda timings: views.timing_summary(timings),
    "SELECT count(*) AS rows, count(DISTINCT function) AS n_functions, count(DISTINCT search_id) AS n_searches, sum(total_time_ms) AS total_ms "
    "FROM timings",
    "total_ms",
)
add(
    "D34_timing_by_function",
    lambda timings: views.timing_by_function(timings),
    "SELECT function, sum(total_time_ms) / NULLIF(sum(num_calls), 0) AS ms_per_call, sum(total_time_ms) AS total_ms, CAST(sum(num_calls) AS BIGINT) AS calls "
    "FROM timings WHERE function <> 'ROOT' GROUP BY function ORDER BY total_ms DESC, function LIMIT 15",
    "ms_per_call total_ms",
)
add(
    "D35_time_management",
    lambda searched: views.time_management(searched),
    f"SELECT avg(time_ms) AS avg_time, median(time_ms) AS median_time, max(time_ms) AS max_time, avg({_n('(nodes + qnodes)', '(time_ms / 1000)')}) AS avg_nps, avg(completed_depth) AS avg_depth "
    f"FROM searches",
    "avg_time median_time max_time avg_nps avg_depth",
)
add(
    "D36_nps_by_depth",
    lambda iteration_rows: views.averaged(iteration_rows, "depth", "nps"),
    f"SELECT depth, avg({_n('(nodes + qnodes)', '(time_ms / 1000)')}) AS nps FROM iterations GROUP BY depth",
    "nps",
)
add(
    "D37_time_histogram",
    lambda searched: views.histogram(searched.where(F.col("total_time_ms").between(1, 60000)), "total_time_ms", 250),
    "SELECT floor(time_ms / 250) * 250 AS bin, count(*) AS count FROM searches WHERE time_ms BETWEEN 1 AND 60000 GROUP BY 1",
    "bin",
)
add(
    "D38_time_by_depth",
    lambda iteration_rows: views.time_by_depth(iteration_rows),
    "SELECT depth, sum(time_ms) AS total_ms FROM iterations GROUP BY depth",
    "total_ms",
)
add(
    "D39_root_move_summary",
    lambda root_moves: views.root_move_summary(root_moves),
    "SELECT count(*) AS rows, count(DISTINCT move) AS n_moves, avg(eval) AS avg_eval, avg(nodes) AS avg_nodes, max(nodes) AS max_nodes "
    "FROM root_moves",
    "avg_eval avg_nodes",
)
add(
    "D39_root_moves_by_nodes",
    lambda root_moves: views.root_moves_by(root_moves, "nodes"),
    "SELECT move, avg(nodes) AS avg_nodes, count(*) AS n FROM root_moves GROUP BY move ORDER BY avg_nodes DESC, move LIMIT 20",
    "avg_nodes",
)
add(
    "D39_root_move_frequency",
    lambda root_moves: views.counted(root_moves, "move", "move", 20),
    "SELECT move, count(*) AS count FROM root_moves GROUP BY move ORDER BY count DESC, move LIMIT 20",
)
add(
    "D39_root_eval_histogram",
    lambda root_moves: views.histogram(root_moves.where(F.col("eval").between(-300, 300)), "eval", 50),
    "SELECT floor(eval / 50.0) * 50 AS bin, count(*) AS count FROM root_moves WHERE eval BETWEEN -300 AND 300 GROUP BY 1",
    "bin",
)
add(
    "D40_eval_accuracy",
    lambda searched: views.eval_accuracy(searched),
    "SELECT count(*) AS total_with_sf, avg(abs(eval - sf_eval)) AS mae, median(abs(eval - sf_eval)) AS median_ae, avg(CASE WHEN move = sf_best_move THEN 1.0 ELSE 0 END) AS best_move_match_rate, stddev_samp(eval - sf_eval) AS stddev_diff "
    "FROM searches WHERE eval IS NOT NULL AND sf_eval IS NOT NULL",
    "mae median_ae best_move_match_rate stddev_diff",
)
add(
    "D41_eval_differences",
    lambda searched: views.eval_differences(searched),
    "SELECT floor((eval - sf_eval) / 25.0) * 25 AS bin, count(*) AS count FROM searches WHERE abs(eval - sf_eval) < 500 GROUP BY 1",
    "bin",
)
add(
    "D41_move_ranks",
    lambda searched: views.move_ranks(searched),
    "SELECT CASE WHEN move = sf_best_move THEN 'best' ELSE 'other' END AS rank_label, count(*) AS count FROM searches "
    "WHERE move IS NOT NULL AND sf_best_move IS NOT NULL GROUP BY 1",
)
add(
    "D41_agreement_by_depth",
    lambda searched: views.agreement_by_depth(searched),
    "SELECT completed_depth AS depth, avg(CASE WHEN move = sf_best_move THEN 1.0 ELSE 0 END) AS agreement_rate, count(*) AS n "
    "FROM searches WHERE move IS NOT NULL AND sf_best_move IS NOT NULL AND completed_depth BETWEEN 1 AND 30 GROUP BY 1 "
    "HAVING count(*) >= 5",
    "agreement_rate",
)
add("D41_blunders", lambda searched: views.blunders(searched), "SELECT count(*) AS count FROM searches WHERE abs(eval - sf_eval) > 200")
add(
    "D42_sprt_summary",
    lambda sprt_runs: views.sprt_summary(sprt_runs),
    "SELECT count(*) AS total, count(*) FILTER (result IN ('pass', 'H1')) AS passed, count(*) FILTER (result IN ('fail', 'H0')) AS failed, count(*) FILTER (result = 'inconclusive' OR result IS NULL) AS open, avg(num_games) AS avg_games "
    "FROM sprt_runs",
    "avg_games",
)
add(
    "D42_sprt_by_book",
    lambda sprt_runs: views.counted(sprt_runs.where(views.filled("book")), "book", "book"),
    "SELECT book, count(*) AS count FROM sprt_runs WHERE book <> '' GROUP BY book",
)
add(
    "D42_sprt_elo_histogram",
    lambda sprt_runs: views.histogram(sprt_runs, "elo_diff", 20),
    "SELECT floor(elo_diff / 20) * 20 AS bin, count(*) AS count FROM sprt_runs WHERE elo_diff IS NOT NULL GROUP BY 1",
    "bin",
)
add("D43_S34_freshness", lambda searches: views.freshness(searches), "SELECT count(*) AS n, coalesce(max(id), 0) AS last_id FROM searches")

# further rows of the inventory
add(
    "P01_P04_star_modifiers",
    lambda games: games.withColumn("result", F.upper("result")).drop("opening_eco").withColumn("sf_eval", F.lit(None).cast("int")).select("id", "result", "sf_eval", F.coalesce("opening", F.lit("?")).alias("opening")),
    "SELECT id, result, sf_eval, coalesce(opening, '?') AS opening "
    "FROM (SELECT * EXCLUDE (opening_eco) REPLACE (upper(result) AS result), CAST(NULL AS INTEGER) AS sf_eval FROM games) AS q",
)
add(
    "P06_outcome_scores",
    lambda searches, games: searches.alias("s").join(games.alias("g"), F.col("s.game_id") == F.col("g.id"), "left").select("s.id", search.outcome_score().alias("score")),
    "SELECT s.id AS id, CASE WHEN s.engine_id = g.white_engine_id AND g.result = 'white' OR s.engine_id = g.black_engine_id AND g.result = 'black' THEN 1 WHEN g.result = 'draw' THEN 0 ELSE -1 END AS score "
    "FROM searches s LEFT JOIN games g ON s.game_id = g.id",
)
add(
    "P10_P12_unguarded_shares",
    lambda searches: searches.select("id", safe.divided(100 * F.col("nmp"), "time_ms").alias("percent"), (F.col("fail_lows") / F.greatest(F.lit(1), F.col("depth") - 5)).alias("per_depth")),
    "SELECT id, CASE WHEN time_ms <> 0 THEN 100.0 * nmp / time_ms END AS percent, CAST(fail_lows AS DOUBLE) / greatest(1, depth - 5) AS per_depth "
    "FROM searches",
    "percent per_depth",
)
add(
    "J04_J09_searches_with_engines",
    lambda searches, engines: searches.join(views.engine_labels(engines).withColumnRenamed("id", "eid"), F.col("engine_id") == F.col("eid"), "left").select("id", "label"),
    "SELECT s.id AS id, e.name || ' (' || e.version || ')' AS label FROM searches s LEFT JOIN engines e ON s.engine_id = e.id",
)
add(
    "J13_records_merged_by_game",
    lambda events: events.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"), safe.latest_known(F.when(F.col("event_type") == "view", F.col("value")), "event_id").alias("last_view"), safe.latest_known(F.when(F.col("event_type") != "view", F.col("value")), "event_id").alias("last_other")),
    "SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(value, event_id) FILTER (event_type = 'view') AS last_view, arg_max(value, event_id) FILTER (event_type <> 'view') AS last_other "
    "FROM events GROUP BY user_id",
    "last_view last_other",
)
add(
    "J15_aligned_samples",
    lambda events: events.where("event_type = 'view'").select("user_id", F.col("value").alias("a")).groupBy("user_id").agg(F.max("a").alias("a")).join(events.where("event_type = 'error'").groupBy("user_id").agg(F.max("value").alias("b")), "user_id"),
    "SELECT user_id, max(value) FILTER (event_type = 'view') AS a, max(value) FILTER (event_type = 'error') AS b FROM events "
    "GROUP BY user_id HAVING a IS NOT NULL AND b IS NOT NULL",
    "a b",
)
add(
    "A01_A04_counts",
    lambda games: games.agg(F.count("*").alias("n"), F.count_distinct("opening").alias("openings"), F.count_distinct("opening_eco").alias("ecos"), F.count_if(F.col("opening").isNull() | (F.col("opening") == "")).alias("unnamed")),
    "SELECT count(*) AS n, count(DISTINCT opening) AS openings, count(DISTINCT opening_eco) AS ecos, count(*) FILTER (opening IS NULL OR opening = '') AS unnamed "
    "FROM games",
)
add(
    "A08_T01_grouped_having",
    lambda games: games.groupBy("opening").agg(F.count("*").alias("n"), F.avg("run_time_s").alias("mean")).where("n >= 2").orderBy(F.desc("n"), F.asc_nulls_last("opening")).limit(15),
    "SELECT opening, count(*) AS n, avg(run_time_s) AS mean FROM games GROUP BY opening HAVING count(*) >= 2 "
    "ORDER BY n DESC, opening NULLS LAST LIMIT 15",
    "mean",
)
add(
    "A22_binned",
    lambda events: events.select(safe.binned("value", 25.0).alias("bin")).groupBy("bin").agg(F.count("*").alias("n")),
    "SELECT floor(value / 25) * 25 AS bin, count(*) AS n FROM events GROUP BY 1",
    "bin",
)
add(
    "A31_pairwise_results",
    lambda orders: match.pairwise(orders.select((F.col("o_custkey") % 12).cast("string").alias("white"), (F.col("o_orderkey") % 11).cast("string").alias("black"), F.when(F.col("o_orderstatus") == "O", "1-0").when(F.col("o_orderstatus") == "F", "0-1").otherwise("1/2-1/2").alias("result"))),
    "SELECT name, opponent, count(*) FILTER (p = 1) AS wins, count(*) FILTER (p = 0) AS draws, count(*) FILTER (p = -1) AS losses "
    "FROM (SELECT CAST(o_custkey % 12 AS VARCHAR) AS name, CAST(o_orderkey % 11 AS VARCHAR) AS opponent, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END AS p "
    "FROM orders "
    "UNION ALL SELECT CAST(o_orderkey % 11 AS VARCHAR), CAST(o_custkey % 12 AS VARCHAR), CASE o_orderstatus WHEN 'O' THEN -1 WHEN 'F' THEN 1 ELSE 0 END "
    "FROM orders) AS x GROUP BY 1, 2",
)
add(
    "O03_O05_nested_selects",
    lambda searches, games: searches.join(games.where("result = 'draw'").select(F.col("id").alias("game_id")), "game_id", "left_semi").groupBy("engine_id").agg(F.count("*").alias("n")),
    "WITH drawn AS (SELECT id FROM games WHERE result = 'draw') SELECT engine_id, count(*) AS n FROM (SELECT * FROM searches "
    "WHERE game_id IN (SELECT id FROM drawn)) AS q GROUP BY engine_id",
)
add(
    "O07_distinct_paths",
    lambda pages: pages.select(safe.last_part("url", "/").alias("leaf")).distinct(),
    "SELECT DISTINCT list_extract(string_split(url, '/'), -1) AS leaf FROM pages",
)
add(
    "F16_F17_arithmetic",
    lambda orders: orders.select("o_orderkey", F.expr("o_orderkey div 7").alias("d"), (F.col("o_orderkey") % 7).alias("m"), F.sqrt("o_orderkey").alias("root"), F.exp(-F.col("o_orderkey") / 1e6).alias("e")),
    "SELECT o_orderkey, o_orderkey // 7 AS d, o_orderkey % 7 AS m, sqrt(o_orderkey) AS root, exp(-o_orderkey / 1e6) AS e FROM orders",
    "root e",
)
add(
    "F20_compact_numbers",
    lambda orders: orders.select("o_orderkey", safe.compact(F.col("o_orderkey") * 137).alias("t")),
    "SELECT o_orderkey, CASE WHEN n >= 1000000 THEN printf('%.1fM', round(n / 1000000.0, 1)) WHEN n >= 1000 THEN printf('%.1fK', round(n / 1000.0, 1)) ELSE CAST(n AS VARCHAR) END AS t "
    "FROM (SELECT o_orderkey, o_orderkey * 137 AS n FROM orders) AS q",
)
add(
    "F10_json_text",
    lambda conversations: conversations.groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])).alias("roles")),
    "SELECT conv_id, CAST(to_json(list(role ORDER BY turn)) AS VARCHAR) AS roles FROM conversations GROUP BY conv_id",
)
add(
    "D16_engine_bars",
    lambda searched, engines: views.by_engine(searched, engines, depth=F.avg("completed_depth"), nodes=F.avg("total_nodes"), time=F.avg("total_time_ms"), tt=F.avg("tt_hit_ratio")),
    f"SELECT e.id AS id, e.name || ' (' || e.version || ')' AS engine_label, avg(completed_depth) AS depth, avg(nodes + qnodes) AS nodes, avg(time_ms) AS time, avg({_n('tt_hits', '(nodes + qnodes)')}) AS tt "
    f"FROM searches s JOIN engines e ON s.engine_id = e.id GROUP BY e.id, e.name, e.version",
    "depth nodes time tt",
)
add(
    "D17_iteration_summary",
    lambda iteration_rows: views.summary(iteration_rows, rows=F.count("*"), searches=F.count_distinct("search_id"), max_depth=F.max("depth"), avg_nodes=F.avg("total_nodes")),
    "SELECT count(*) AS rows, count(DISTINCT search_id) AS searches, max(depth) AS max_depth, avg(nodes + qnodes) AS avg_nodes FROM iterations",
    "avg_nodes",
)
add(
    "D18_tree_summary",
    lambda tree_rows: views.summary(tree_rows, rows=F.count("*"), max_ply=F.max("depth"), nodes=F.sum("nodes"), qnodes=F.sum("qnodes"), avg_qratio=F.avg("qratio")),
    f"SELECT count(*) AS rows, max(depth) AS max_ply, CAST(sum(nodes) AS BIGINT) AS nodes, CAST(sum(qnodes) AS BIGINT) AS qnodes, avg({_n('qnodes', '(nodes + qnodes)')}) AS avg_qratio "
    f"FROM tree",
    "avg_qratio",
)
add(
    "D28_position_summary",
    lambda positions: views.summary(positions, n=F.count("*"), types=F.count_distinct("position_type"), phases=F.count_distinct("game_phase"), avg_tactical=F.avg("pos_tactical")),
    "SELECT count(*) AS n, count(DISTINCT position_type) AS types, count(DISTINCT game_phase) AS phases, avg(pos_tactical) AS avg_tactical "
    "FROM positions",
    "avg_tactical",
)
add(
    "D36_mean_time_by_depth",
    lambda iteration_rows: views.averaged(iteration_rows, "depth", "time_ms"),
    "SELECT depth, avg(time_ms) AS time_ms FROM iterations GROUP BY depth",
    "time_ms",
)
add(
    "D39_root_moves_by_time",
    lambda root_moves: views.root_moves_by(root_moves, "time_ms"),
    "SELECT move, avg(time_ms) AS avg_time_ms, count(*) AS n FROM root_moves GROUP BY move ORDER BY avg_time_ms DESC, move LIMIT 20",
    "avg_time_ms",
)
add(
    "D40_quality_gate",
    lambda searches: searches.where("sf_eval IS NOT NULL").agg(F.count("*").alias("n")),
    "SELECT count(*) AS n FROM searches WHERE sf_eval IS NOT NULL",
)
add(
    "D42_sprt_games",
    lambda sprt_runs: views.histogram(sprt_runs, "num_games", 50),
    "SELECT floor(num_games / 50.0) * 50 AS bin, count(*) AS count FROM sprt_runs WHERE num_games IS NOT NULL GROUP BY 1",
    "bin",
)
add(
    "D42_sprt_timeline",
    lambda sprt_runs: sprt_runs.where("elo_diff IS NOT NULL").select("id", "elo_diff", "result", (F.col("elo1") - F.col("elo0")).alias("bounds")),
    "SELECT id, elo_diff, result, CAST(elo1 - elo0 AS DOUBLE) AS bounds FROM sprt_runs WHERE elo_diff IS NOT NULL",
    "elo_diff bounds",
)

paths.add_all(add)
