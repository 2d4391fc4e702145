"""Schemas of logs and of the warehouse's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()
_LONGS, _DOUBLES, _TEXTS = T.ArrayType(_LONG), T.ArrayType(_DOUBLE), T.ArrayType(_TEXT)


def struct(*kinds: tuple[str, T.DataType]) -> T.StructType:
    """Of names, apart by spaces, and their type."""
    return T.StructType([T.StructField(n, t) for names, t in kinds for n in names.split()])


def _prefixed(prefix: str, names: str) -> str:
    return " ".join(f"{prefix}_{n}" for n in names.split())


GAME_LOG = struct(
    ("game_uuid engine_id side result reason opening start_fen", _TEXT), ("wtime btime winc binc movestogo depth nodes movetime", _LONG), ("moves", _TEXTS), ("time_s", _DOUBLE),
)
SEARCH_LOG = struct(
    ("search_uuid game_uuid engine_id fen best_move", _TEXT), ("time_ms tt_fill", _DOUBLE), ("principal_variation", _TEXTS), ("fail_high_index", _LONGS),
    ("ply root_eval completed_depth max_depth max_qdepth nodes qnodes tt_stores tt_hits fail_highs fail_lows aspiration_fail_high_researches aspiration_fail_low_researches see_prunes delta_prunes nmp nmp_failhigh tt_overwritten", _LONG),
    (_prefixed("itdepth", "nodes eval qdepth qnodes ttstores tthits fail_highs fail_lows aspiration_failhigh_researches aspiration_faillow_researches see_prunes delta_prunes pvs_researches nmp nmp_failhigh"), _LONGS),
    (_prefixed("itdepth", "time_ms ttfill"), _DOUBLES), ("itdepth_move", _TEXTS), ("itdepth_fh_index treedepth_fh_index", T.ArrayType(_LONGS)),
    (_prefixed("treedepth", "nodes qnodes tt_stores tt_hits fail_highs fail_lows see_prunes delta_prunes pvs_researches nmp nmp_failhigh"), _LONGS),
)
ROOT_MOVES_LOG = struct(("search_uuid", _TEXT), ("depth", _LONG), ("moves", T.ArrayType(struct(("move", _TEXT), ("eval time_ms nodes", _LONG)))))
SUITE_LOG = struct(("epd_file category fen engine_move", _TEXT), ("index expected_score engine_score score_diff", _LONG), ("expected_moves avoid_moves", _TEXTS))
#: Keys of a timing record that name no function.
TIMING_KEYS = ["engine_id", "instance_id", "type", "session", "game_uuid", "search_uuid", "fen", "total_search_time_ms"]

#: Fixed values of the data model: columns that reports need; tables of the second kind may not be built yet, those of the third may be absent.
REQUIRED = {
    "search_stats": "id engine_id fen ply time_ms eval completed_depth depth qdepth move nodes qnodes tt_stores tt_hits fail_highs fail_lows nmp nmp_failhigh",
    "engines": "id name version", "game_stats": "id result opening run_time_s", "iterative_deepening_stats": "search_id depth qdepth time_ms eval move nodes qnodes tt_hits fail_highs",
    "search_tree_stats": "search_id depth nodes qnodes fail_highs fail_lows nmp",
}
FEATURES = {
    "search_features": "search_id engine_id fen total_time_ms final_eval completed_depth total_nodes nps qratio tt_hit_ratio fail_high_ratio avg_ebf",
    "search_iteration_features": "search_id depth qdepth nodes qnodes nps ebf qratio tt_hit_ratio", "search_tree_features": "search_id depth nodes qnodes ebf qratio tt_hit_ratio",
}
OPTIONAL = {"search_timings": "search_id function total_time_ms num_calls", "root_moves": "search_id move eval", "sprt_runs": "id result", "sts_runs": "id suite", "engine_ratings": "engine_id"}
