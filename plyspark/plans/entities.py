"""The telemetry entities laid over the driver's star-schema tables.

Each entity is one SQL text in the dialect that Spark and DuckDB share, over the
tables and earlier entities, so a query and its oracle begin from the same rows. An entity that adds doubles up and
rounds the sum has a form for Spark beside it, which adds in a fixed order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

_COUNTERS = """
  {k} % 53 AS tt_stores, {k} % 47 AS tt_hits, {k} % 19 AS fail_highs, {k} % 13 AS fail_lows,
  {k} % 5 AS fh_index_0, {k} % 4 AS fh_index_1, {k} % 3 AS fh_index_2, {k} % 2 AS fh_index_3, {k} % 7 AS fh_index_4to7, NULLIF({k} % 6, 5) AS fh_index_8plus,
  {k} % 29 AS see_prunes, {k} % 31 AS delta_prunes, {k} % 17 AS pvs_researches, {k} % 23 AS nmp, {k} % 11 AS nmp_failhigh
"""

#: Positions that boards are made of.
BOARDS = [
    "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", "8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 41",
    "r1bq1rk1/pp2bppp/2n1pn2/3p4/3P4/2NB1N2/PP3PPP/R1BQ1RK1 b - - 4 22", "4k3/8/8/8/8/8/4P3/4K3 w - - 5 60", "r2q1rk1/pP1p2pp/Q4n2/bbp1p3/Np6/1B3NBn/pPPP1PPP/R3K2R b KQ - 0 16",
]

#: Openings that games are made of, in moves of four characters.
LINES = [
    "e2e4 e7e5 g1f3 b8c6 f1b5 a7a6 b5a4 g8f6 e1g1 f8e7", "e2e4 c7c5 g1f3 d7d6 d2d4 c5d4 f3d4 g8f6 b1c3 a7a6", "d2d4 d7d5 c2c4 e7e6 b1c3 g8f6 c1g5 f8e7 e2e3 e8g8", "d2d4 g8f6 c2c4 g7g6 b1c3 f8g7 e2e4 d7d6 g1f3 e8g8",
    "c2c4 e7e5 b1c3 g8f6 g1f3 b8c6 g2g3 d7d5 c4d5 f6d5", "e2e4 e7e6 d2d4 d7d5 b1c3 f8b4 e4e5 c7c5 a2a3 b4c3", "e2e4 c7c6 d2d4 d7d5 e4e5 c8f5 g1f3 e7e6 f1e2 c6c5",
]

#: Ranks that boards are put together from, from Black's side down.
RANKS = ["r1bqkb1r", "pp2p1pp", "2n1p3", "3pP3", "1p1P4", "2N2Q1p", "PP1B1PPP", "R3K2R"]
_RANK = lambda k: f"CASE (o_orderkey + o_custkey * {k}) % {3 + k % 3} WHEN 0 THEN '{RANKS[k]}' WHEN 1 THEN '8' WHEN 2 THEN '{RANKS[(k * 3 + 2) % 8]}' ELSE '{k or 3}{'p' if k % 2 else 'N'}{7 - (k or 3) or ''}' END"

ENTITIES = {
    "engines": "SELECT CAST(n_nationkey AS BIGINT) + 1 AS id, n_name AS name, 'v' || CAST(n_regionkey AS VARCHAR(9)) AS version FROM nation WHERE n_nationkey < 20",
    "games": """SELECT c_custkey AS id, c_custkey % 21 + 1 AS white_engine_id, (c_custkey + 7) % 21 + 1 AS black_engine_id,
        CASE WHEN c_nationkey % 3 = 0 THEN 'white' WHEN c_nationkey % 3 = 1 THEN 'black' WHEN c_custkey % 5 = 0 THEN NULL ELSE 'draw' END AS result,
        c_custkey % 7 AS termination, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR(9)) END AS opening,
        CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE substring('ABCDE', CAST(c_custkey % 5 AS INT) + 1, 1) || CAST(c_nationkey AS VARCHAR(9)) END AS opening_eco,
        NULLIF(c_acctbal, 0) AS run_time_s FROM customer""",
    "suites": """SELECT p_partkey AS id, 'C:\\sets\\' || p_brand AS path, p_brand || ' - ' || p_type AS category, p_size % 2 = 0 AS move_is_correct, p_size AS engine_score,
        CAST(p_partkey % 50 AS INT) AS expected_score FROM part""",
    "searches": f"""SELECT o_orderkey AS id, o_custkey % 22 + 1 AS engine_id, o_custkey AS game_id, o_orderkey % 2500 AS sts_id, o_orderpriority || '/' || o_orderstatus AS fen, o_orderkey % 80 AS ply,
        CAST(o_orderkey % 7 AS DOUBLE) * 250 AS time_ms, NULLIF(o_orderkey * 7919 % 1201 - 600, 0) AS eval, NULLIF(o_orderkey * 104729 % 1301 - 650, 13) AS sf_eval,
        o_orderkey % 27 AS completed_depth, 1 + o_orderkey % 29 AS depth, o_orderkey % 33 AS qdepth, NULLIF('m' || CAST(o_orderkey % 6 AS VARCHAR(9)), 'm5') AS move,
        'm' || CAST(o_custkey % 6 AS VARCHAR(9)) AS sf_best_move,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN '[]' ELSE '["m' || CAST(o_custkey % 6 AS VARCHAR(9)) || '","m1","m2"]' END AS sf_pv, '[]' AS principal_variation,
        o_orderkey * 37 % 1009 AS nodes, o_orderkey * 53 % 911 AS qnodes, o_orderkey % 5 AS fail_high_researches, o_orderkey % 4 AS fail_low_researches, o_orderkey % 3 AS tt_overwritten, {_COUNTERS.format(k='o_orderkey')} FROM orders""",
    "iterations": f"""SELECT search_id, CAST(row_number() OVER (PARTITION BY search_id ORDER BY event_id) AS BIGINT) AS depth, event_id % 9 AS qdepth, value AS time_ms, value - 245.0 AS eval, event_type AS move,
        event_id * 31 % 997 AS nodes, event_id * 17 % 499 AS qnodes, event_id % 3 AS fail_high_researches, event_id % 2 AS fail_low_researches, {_COUNTERS.format(k='event_id')} FROM (SELECT user_id AS search_id, event_id, value, event_type FROM events) AS r""",
    "tree": f"""SELECT search_id, CAST(row_number() OVER (PARTITION BY search_id ORDER BY l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS depth,
        l_partkey % 200 AS nodes, l_suppkey % 90 AS qnodes, {_COUNTERS.format(k='l_partkey')} FROM (SELECT l_orderkey AS search_id, l_linenumber, l_partkey, l_suppkey FROM lineitem) AS r""",
    "timings": """SELECT user_id AS search_id, CASE event_type WHEN 'view' THEN 'ROOT' WHEN 'click' THEN 'MAKEMOVE' WHEN 'purchase' THEN 'NNUE' WHEN 'signup' THEN 'EVAL' ELSE 'SEE' END AS function,
        CAST(round(sum(value)) AS DOUBLE) AS total_time_ms, count(*) AS num_calls FROM events GROUP BY user_id, event_type""",
    "root_moves": """SELECT l_orderkey AS search_id, CAST(l_linenumber AS BIGINT) AS depth, l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR(9)) AS move,
        CAST(l_partkey % 700 - 350 AS BIGINT) AS eval, CAST(l_suppkey % 40 AS BIGINT) AS time_ms, CAST(l_partkey AS BIGINT) AS nodes FROM lineitem""",
    "positions": """SELECT o_orderkey AS search_id, o_custkey AS game_id, o_orderpriority AS fen, CASE o_orderkey % 3 WHEN 0 THEN 'opening' WHEN 1 THEN 'midgame' ELSE 'endgame' END AS game_phase,
        CASE o_orderkey % 4 WHEN 0 THEN 'Tactical' WHEN 1 THEN 'Positional' WHEN 2 THEN 'Endgame' ELSE NULL END AS position_type, CAST(o_orderkey % 11 AS DOUBLE) / 10 AS pos_tactical,
        CAST(o_orderkey % 13 AS DOUBLE) / 12 AS pos_positional, CAST(o_orderkey % 8 AS DOUBLE) / 7 AS pos_endgame, o_orderkey % 9 - 4 AS balance FROM orders WHERE o_orderkey % 5 <> 0""",
    "sprt_runs": """SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 'pass' WHEN 1 THEN 'H1' WHEN 2 THEN 'fail' WHEN 3 THEN 'H0' ELSE 'inconclusive' END AS result, s_acctbal / 100 AS elo_diff,
        NULLIF(s_suppkey * 3 % 400, 0) AS num_games, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'book' || CAST(s_nationkey % 4 AS VARCHAR(9)) END AS book, 0.0 AS elo0, CAST(s_suppkey % 3 * 5 AS DOUBLE) AS elo1 FROM supplier""",
    "records": """SELECT o_custkey AS engine_id, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS wins, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS draws,
        sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS losses FROM orders GROUP BY o_custkey""",
    "boards": "SELECT o_orderkey AS id, CASE o_orderkey % 6 " + " ".join(f"WHEN {k} THEN '{fen}'" for k, fen in enumerate(BOARDS)) + " END AS fen FROM orders",
    "mixed_boards": "SELECT o_orderkey AS id, " + " || '/' || ".join(_RANK(k) for k in range(8)) + " || CASE o_orderkey % 2 WHEN 0 THEN ' w' ELSE ' b' END || ' KQkq - 0 ' || CAST(o_custkey % 60 + 1 AS VARCHAR(9)) AS fen FROM orders",
    "placed": """SELECT id, square, piece FROM (SELECT l_orderkey - l_orderkey % 8 AS id, l_partkey % 64 AS square, substring('PNBRQKpnbrqk', CAST(l_suppkey % 12 AS INT) + 1, 1) AS piece,
        row_number() OVER (PARTITION BY l_orderkey - l_orderkey % 8, l_partkey % 64 ORDER BY l_orderkey, l_linenumber, l_suppkey) AS k FROM lineitem) AS r WHERE k = 1""",
    "lines_played": "SELECT o_orderkey AS id, substring(CASE o_custkey % 7 " + " ".join(f"WHEN {k} THEN '{line}'" for k, line in enumerate(LINES)) + " END, 1, CAST(5 * (o_orderkey % 11) AS INT)) AS moves FROM orders",
    "played": """SELECT run, CAST(row_number() OVER (PARTITION BY run ORDER BY o_orderkey) AS BIGINT) AS game_num, CASE o_orderstatus WHEN 'O' THEN 'w' WHEN 'P' THEN 'd' ELSE 'l' END AS outcome
        FROM (SELECT o_custkey AS run, o_orderkey, o_orderstatus FROM orders) AS r""",
}
#: Sums of doubles depend on their order, and a half is rounded up or down by the last digit. So Spark adds events by their ids, as SQL on one thread does that reads
#: them in that order, and not by the parts that a file happens to be split into.
IN_ORDER = {
    "timings": """SELECT search_id, function, CAST(round(max_by(total, n)) AS DOUBLE) AS total_time_ms, CAST(max(n) AS BIGINT) AS num_calls FROM (
        SELECT user_id AS search_id, event_type, CASE event_type WHEN 'view' THEN 'ROOT' WHEN 'click' THEN 'MAKEMOVE' WHEN 'purchase' THEN 'NNUE' WHEN 'signup' THEN 'EVAL' ELSE 'SEE' END AS function,
        sum(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id, value ROWS UNBOUNDED PRECEDING) AS total,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id, value) AS n FROM events) AS r GROUP BY search_id, event_type, function""",
}
#: Entities with windows by a key: the table and its key. Rows become wide and are sorted several times in a task, so a large table is dealt by the
#: key into parts of TASK_ROWS on average, in the one exchange that the windows need: a task's memory doesn't follow the input.
DEALT = {"iterations": ("events", "user_id"), "timings": ("events", "user_id"), "tree": ("lineitem", "l_orderkey")}
TASK_ROWS = 200_000
_USES = {name: [x for x in [*ENTITIES, *TABLES] if re.search(rf"\b(FROM|JOIN) {x}\b", sql)] for name, sql in ENTITIES.items()}


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An entity over the Parquet tables of ``sf_dir``."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _USES[name]}
    if name in DEALT:
        table, key = DEALT[name]
        if (rows := frames[table].count()) > TASK_ROWS:
            frames[table] = frames[table].repartition(max(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism), key)
    sql = IN_ORDER.get(name, ENTITIES[name]).replace("\\", "\\\\")
    for t in frames:
        sql = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", sql)
    return spark.sql(sql.replace("'[\"", "'[\""), **frames)


def with_entities(sql: str) -> str:
    """DuckDB SQL whose names of entities are found as common table expressions."""
    used = [n for n in ENTITIES if re.search(rf"\b{n}\b", sql)]
    ctes = ", ".join(f"{n} AS ({ENTITIES[n]})" for n in used)
    if not ctes:
        return sql
    return f"WITH {ctes}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {ctes} {sql}"
