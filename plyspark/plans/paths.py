"""Queries of the data path: ranks, loads, positions, text; and rows of reports beside those of the catalogue."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paired import paired_tests
from ..functions.safe import sample_rows
from ..operators import bitboards, frontier, positions
from ..operators.order import ranked, running_total
from ..operators.search import FH_BUCKETS
from ..scratch import shared_folder
from ..sources import intake, reports
from ..sources.positions import classified, epd, move_tokens, pgn_openings
from . import views, warehouse
from .entities import LINES, entity
from .store import Store

RATIO = "CAST({} AS DOUBLE) / NULLIF({}, 0)"


# ranks and statistics over whole tables


def ranked_orders(orders: DataFrame) -> DataFrame:
    return ranked(orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], start=10).select("o_orderkey", "id")


def running_orders(orders: DataFrame) -> DataFrame:
    return running_total(orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], "o_custkey", "total").select("o_orderkey", "total")


def paired_statistics(events: DataFrame) -> DataFrame:
    """Signed-rank, paired t and Kolmogorov-Smirnov statistics of users' mean views against their mean clicks."""
    mean = lambda kind: F.avg(F.when(F.col("event_type") == kind, F.round("value"))).alias(kind)
    found = paired_tests(events.groupBy("user_id").agg(mean("view"), mean("click")), "view", "click")
    pick = lambda name: None if found[name] is None else float(found[name][0])
    row = (int(found["summary"]["n"]), pick("wilcoxon"), pick("ttest_rel"), pick("ks_2samp"))
    return events.sparkSession.createDataFrame([row], "n long, wilcoxon double, t double, ks double")


PAIRED_SQL = """
WITH p AS (SELECT avg(round(value)) FILTER (event_type = 'view') AS x, avg(round(value)) FILTER (event_type = 'click') AS y FROM events GROUP BY user_id),
d AS (SELECT x, y, x - y AS d FROM p WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS rank FROM d WHERE d <> 0),
z AS (SELECT x AS v, 1 AS s FROM d UNION ALL SELECT y, -1 FROM d),
g AS (SELECT v, sum(sum(s)) OVER (ORDER BY v) AS gap FROM z GROUP BY v)
SELECT (SELECT count(*) FROM d) AS n, (SELECT least(sum(rank) FILTER (d > 0), sum(rank) FILTER (d < 0)) FROM r) AS wilcoxon,
  (SELECT avg(d) / (stddev_samp(d) / sqrt(count(*))) FROM d) AS t, (SELECT max(abs(gap)) / (SELECT count(*) FROM d) FROM g) AS ks"""


# loads in parts


def _loaded_twice(spark: SparkSession, sf_dir: str, early: str, late: bool) -> DataFrame:
    """Timings as loaded from a raw store that has the ``early`` ones first and then all."""
    root = shared_folder(spark, "loads")
    raw, to = warehouse.Store(spark, f"{root}/raw"), warehouse.Store(spark, f"{root}/analytics")
    rows = entity(spark, sf_dir, "timings")
    raw.write("timing", rows.where(early))
    warehouse.load(raw, to)
    raw.write("timing", rows)
    warehouse.load(raw, to, late=late)
    return to.read("search_timings").select("search_id", "function", "total_time_ms", "num_calls")


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_twice(spark, sf_dir, "search_id <= 40", late=False)


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_twice(spark, sf_dir, "search_id % 3 <> 0", late=True)


def late_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings of searches of which one function came first and the others late, some rows twice."""
    root, rows = shared_folder(spark, "late"), entity(spark, sf_dir, "timings")
    raw, to = warehouse.Store(spark, f"{root}/raw"), warehouse.Store(spark, f"{root}/analytics")
    raw.write("timing", rows.where("function = 'ROOT'"))
    warehouse.load(raw, to, late=True)
    for late in ("function IN ('NNUE', 'SEE') OR function = 'ROOT' AND search_id % 5 = 0", "function NOT IN ('ROOT', 'NNUE', 'SEE')"):
        raw.append("timing", rows.where(late))
        warehouse.load(raw, to, late=True)
    return to.read("search_timings").select("search_id", "function", "total_time_ms", "num_calls")


def merged_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches after an upsert of the lowest hundredth of ids: new evaluations, nodes added up."""
    store = Store(spark, shared_folder(spark, "merge"), {"searches": ("id",)})
    rows = entity(spark, sf_dir, "searches").select("id", "eval", "nodes")
    store.write("searches", rows)
    most = store.last_id("searches") // 100
    store.merge("searches", rows.where(F.col("id") <= most).select("id", (F.col("eval") + 1).alias("eval"), F.lit(5).cast("long").alias("nodes")), add=("nodes",))
    return store.read("searches")


MERGED_SQL = """SELECT id, CASE WHEN id <= most // 100 THEN eval + 1 ELSE eval END AS eval, CASE WHEN id <= most // 100 THEN nodes + 5 ELSE nodes END AS nodes
  FROM searches, (SELECT max(id) AS most FROM searches) AS q"""


def pinned_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games and searches as each version of a store has them: both of one commit, the second reading what the first wrote."""
    store = Store(spark, shared_folder(spark, "versions"), {"searches": ("id",)})
    games, searches = entity(spark, sf_dir, "games").select("id", "result"), entity(spark, sf_dir, "searches").select("id", "game_id", "nodes")
    for k in range(3):
        with store.begin() as commit:
            commit.append("games", games.where(F.col("id") % 3 == k))
            known = commit.read("games").select(F.col("id").alias("game_id"))
            commit.append("searches", searches.where(F.col("game_id") % 3 == k).join(known, "game_id", "left_semi").select(searches.columns))
    rows = [store.at(v).read("searches").agg(F.lit(v).alias("version"), F.count("*").alias("n"), F.sum("nodes").alias("nodes")) for v in store.versions()]
    return reduce(DataFrame.unionAll, rows)


VERSIONS_SQL = """SELECT CAST(v AS INTEGER) AS version, count(*) AS n, CAST(sum(nodes) AS BIGINT) AS nodes FROM searches, range(1, 4) AS r(v)
  WHERE game_id % 3 < v AND game_id IN (SELECT id FROM games) GROUP BY v"""
TIMINGS_SQL = "SELECT search_id, function, total_time_ms, num_calls FROM timings"


# files written from tables and read back


def log_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines in files that come in two goes, some lines broken, taken in three: (status, n, total), a row of rejected lines beside."""
    root = shared_folder(spark, "intake")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_custkey")
    broken = F.col("o_orderkey") % 97 == 0
    lines = orders.select("o_orderkey", F.when(broken, F.concat(F.lit("bad "), F.col("o_orderkey").cast("string"))).otherwise(F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_custkey"))).alias("value"))
    store, schema = Store(spark, f"{root}/store"), orders.schema
    for k in range(2):
        lines.where(F.col("o_orderkey") % 2 == k).select("value").write.mode("append").text(f"{root}/logs")
        intake.take(store, f"{root}/logs", "log", schema, "part-*")
    intake.take(store, f"{root}/logs", "log", schema, "part-*")
    good = store.read("log").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("total"))
    ledger = store.read(intake.LEDGER).agg(F.lit("rejected").alias("status"), F.sum("rejected").alias("n"), F.sum("lines").alias("total"))
    return good.unionByName(ledger)


INTAKE_SQL = """SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders WHERE o_orderkey % 97 <> 0 GROUP BY 1
  UNION ALL SELECT 'rejected', count(*) FILTER (o_orderkey % 97 = 0), count(*) FROM orders"""


def suite_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records of a position suite, with comments and blank lines between, read back."""
    path = shared_folder(spark, "suite")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    record = F.concat(F.lit("8/8/4k3/8/3PP3/8/4K3/8 w - - bm e"), (F.col("p_size") % 8 + 1).cast("string"), F.lit(" d5; id "), F.lit('"'), F.col("p_name"), F.lit('"; ce '), F.col("p_partkey").cast("string"), F.lit(";"))
    lines = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("# "), record)).when(F.col("p_partkey") % 11 == 0, F.lit("")).otherwise(record)
    part.select(lines.alias("value")).write.text(path)
    return epd(spark, path).select("ce", F.col("id").alias("name"), F.array_join("expected", " ").alias("expected"), "fen")


SUITE_SQL = """SELECT CAST(p_partkey AS INTEGER) AS ce, p_name AS name, 'e' || CAST(p_size % 8 + 1 AS VARCHAR) || ' d5' AS expected, '8/8/4k3/8/3PP3/8/4K3/8 w - - 0 1' AS fen
  FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0"""


def report_statistics(part: DataFrame) -> DataFrame:
    """Labelled numbers of a report made of each part."""
    n = F.col("p_size").cast("string")
    text = F.concat(F.lit("Engine x 1\nNodes Total   "), n, F.lit("\nQNodes "), (F.col("p_partkey") % 50).cast("string"), F.lit("\nFH % at [0]   "), n, F.lit(".5%   Fail Highs "), n, F.lit("\n 1 2 3\n"))
    found = reports.statistics(part.select("p_partkey", text.alias("text")))
    of = lambda label: reports.labelled(F.col("statistics"), label)
    return found.select("p_partkey", of("Total").alias("total"), of("FH % at [0]").alias("first"), of("Fail Highs").alias("highs"), of("Fail Lows").alias("lows"), "q_ratio")


STATISTICS_SQL = """SELECT p_partkey, CAST(p_size AS DOUBLE) AS total, p_size + 0.5::DOUBLE AS first, CAST(p_size AS DOUBLE) AS highs, CAST(NULL AS DOUBLE) AS lows,
  CASE WHEN p_size > 0 THEN 100.0::DOUBLE * (p_partkey % 50) / p_size END AS q_ratio FROM part"""


def match_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the logs of twenty matches, a file each, with the score after each game; read back and reported."""
    path = shared_folder(spark, "matches")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", (F.col("o_custkey") % 20).alias("match"), "o_orderstatus")
    so_far = Window.partitionBy("match").orderBy("o_orderkey")
    sums = [F.sum((F.col("o_orderstatus") == s).cast("long")).over(so_far).cast("string") for s in ("O", "F", "P")]
    result = F.when(F.col("o_orderstatus") == "O", "1-0").when(F.col("o_orderstatus") == "F", "0-1").otherwise("1/2-1/2")
    game = F.concat(F.lit("Finished game "), F.row_number().over(so_far).cast("string"), F.lit(" (Candidate vs Base): "), result, F.lit(" {done}\nScore of Candidate vs Base: "), sums[0], F.lit(" - "), sums[1], F.lit(" - "), sums[2], F.lit("  [0.5] 9\nSPRT: llr 0.5 (17.0%), lbound -2.94, ubound 2.94"))
    rows = orders.select("match", "o_orderkey", game.alias("value")).repartition("match").sortWithinPartitions("match", "o_orderkey")
    rows.select("match", "value").write.partitionBy("match").text(path)
    lines = reports.lines_of(spark, f"{path}/*")
    number = F.regexp_extract("file", r"match=(\d+)/", 1).cast("long").alias("match")
    games = reports.finished_games(lines).groupBy("file").agg(F.count("*").alias("games"), F.count_if(F.col("result") == "1-0").alias("won"), F.max_by("result", "at").alias("latest"))
    report = reports.match_report(lines).join(games, "file")
    return report.select(number, "candidate_wins", "candidate_losses", "candidate_draws", "games_played", "llr", F.col("result").alias("verdict"), "games", "won", "latest")


MATCHES_SQL = """SELECT o_custkey % 20 AS match, count(*) FILTER (o_orderstatus = 'O') AS candidate_wins, count(*) FILTER (o_orderstatus = 'F') AS candidate_losses, count(*) FILTER (o_orderstatus = 'P') AS candidate_draws,
  count(*) AS games_played, 0.5::DOUBLE AS llr, 'inconclusive' AS verdict, count(*) AS games, count(*) FILTER (o_orderstatus = 'O') AS won,
  arg_max(CASE o_orderstatus WHEN 'O' THEN '1-0' WHEN 'F' THEN '0-1' ELSE '1/2-1/2' END, o_orderkey) AS latest FROM orders GROUP BY 1"""

#: ``entities.LINES`` in the notation of books.
BOOK_LINES = [
    "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7", "1. e4 c5 2. Nf3 d6 3. d4 cxd4 4. Nxd4 Nf6 5. Nc3 a6", "1. d4 d5 2. c4 e6 3. Nc3 Nf6 4. Bg5 Be7 5. e3 O-O", "1. d4 Nf6 2. c4 g6 3. Nc3 Bg7 4. e4 d6 5. Nf3 O-O",
    "1. c4 e5 2. Nc3 Nf6 3. Nf3 Nc6 4. g3 d5 5. cxd5 Nxd5", "1. e4 e6 2. d4 d5 3. Nc3 Bb4 4. e5 c5 5. a3 Bxc3", "1. e4 c6 2. d4 d5 3. e5 Bf5 4. Nf3 e6 5. Be2 c5",
]


def book_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as games of opening books, with remarks and further tags, read back: the moves in UCI."""
    path = shared_folder(spark, "books")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_brand")
    moves = F.get(F.array(*[F.lit(x) for x in BOOK_LINES]), (F.col("p_partkey") % 7).cast("int"))
    moves = F.when(F.col("p_size") % 5 == 0, F.concat(moves, F.lit(" 6. Kxh8 Kxa1"))).otherwise(moves)
    remark = F.when(F.col("p_partkey") % 3 == 0, '{of\n[ECO "Z99"] }\n').otherwise("")
    game = F.concat(F.lit('[ECO "'), F.col("p_partkey").cast("string"), F.lit('"]\n[Opening "'), "p_brand", F.lit('"]\n[Result "*"]\n\n'), remark, moves, F.lit(" *\n"))
    part.select(game.alias("value")).write.text(path)
    return pgn_openings(spark, path).select(F.col("eco").cast("long").alias("p_partkey"), "name", F.array_join("moves", " ").alias("moves"))


_LINE_CASES = " ".join(f"WHEN {k} THEN '{line}'" for k, line in enumerate(LINES))
BOOKS_SQL = f"SELECT p_partkey, p_brand AS name, CASE p_partkey % 7 {_LINE_CASES} END AS moves FROM part"


def perft_counts(boards: DataFrame) -> DataFrame:
    return frontier.perft(boards.withColumn("depth", (F.col("id") % 3 + 1).cast("int"))).select("id", "depth", "nodes")


#: Known numbers of sequences of 1, 2 and 3 moves from each of ``entities.BOARDS``.
PERFT = [(20, 400, 8902), (48, 2039, 97862), (14, 191, 2812), (33, 1413, 47846), (6, 30, 210), (6, 264, 9467)]
PERFT_SQL = f"""WITH known(board, depth, nodes) AS (VALUES {', '.join(f'({b}, {d + 1}, {n})' for b, row in enumerate(PERFT) for d, n in enumerate(row))})
SELECT id, CAST(k.depth AS INTEGER) AS depth, CAST(k.nodes AS BIGINT) AS nodes FROM boards JOIN known k ON id % 6 = k.board AND id % 3 + 1 = k.depth"""


# positions and text


def board_cells(mixed_boards: DataFrame) -> DataFrame:
    return mixed_boards.select("id", positions.cells(F.col("fen")).alias("cells"))


def material(mixed_boards: DataFrame) -> DataFrame:
    board = positions.cells(F.col("fen"))
    return mixed_boards.select("id", positions.game_phase(F.col("fen")).alias("phase"), positions.balance(F.col("fen")).cast("long").alias("balance"), positions.number_of(board, "Pp").cast("long").alias("pawns"))


_FLAT = "regexp_replace(split_part(fen, ' ', 1), '[0-9]', '', 'g')"
_COUNT = lambda p: f"(length({_FLAT}) - length(replace({_FLAT}, '{p}', '')))"
_SIDE = lambda upper: " + ".join(f"{v} * {_COUNT(p.upper() if upper else p)}" for p, v in positions.POINTS.items())
_GONE = f"({positions.PHASE_START} - (" + " + ".join(f"{v} * ({_COUNT(p)} + {_COUNT(p.upper())})" for p, v in positions.PHASE.items()) + "))"
_PLY = "(CAST(split_part(fen, ' ', 6) AS INTEGER) * 2 - CASE split_part(fen, ' ', 2) WHEN 'w' THEN 0 ELSE 1 END)"
MATERIAL_SQL = f"""SELECT id, CASE WHEN {_GONE} < {0.25 * positions.PHASE_START} AND {_PLY} <= 30 THEN 'opening' WHEN {_GONE} < {positions.PHASE_START} * 2 / 3.0 THEN 'midgame' ELSE 'endgame' END AS phase,
  ({_SIDE(True)}) - ({_SIDE(False)}) AS balance, {_COUNT('P')} + {_COUNT('p')} AS pawns FROM mixed_boards"""
_DOTS = "split_part(fen, ' ', 1)"
for _n in range(1, 9):
    _DOTS = f"replace({_DOTS}, '{_n}', '{'.' * _n}')"
CELLS_SQL = f"SELECT id, array_to_string(list_reverse(string_split({_DOTS}, '/')), '') AS cells FROM mixed_boards"


def attacks(placed: DataFrame) -> DataFrame:
    """Attacks on boards put together from their pieces."""
    board = F.expr("array_join(transform(sequence(0, 63), s -> coalesce(try_element_at(men, CAST(s AS BIGINT)), '.')), '')")
    boards = placed.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("square", "piece"))).alias("men")).select("id", board.alias("board"))
    return bitboards.attack_features(boards, "board").drop("board")


_STEPS = ", ".join(
    f"('{kind}', {f}, {r}, {most})"
    for kinds, steps, most in (("rq", bitboards.ROOK, 7), ("bq", bitboards.BISHOP, 7), ("k", bitboards.ROOK + bitboards.BISHOP, 1), ("n", bitboards.LEAPS, 1), ("P", [(-1, 1), (1, 1)], 1), ("p", [(-1, -1), (1, -1)], 1))
    for kind in kinds
    for f, r in steps
)
ATTACKS_SQL = f"""WITH steps(kind, f, r, most) AS (VALUES {_STEPS}),
rays AS (SELECT id, square, piece, f, r, k, square + k * (f + 8 * r) AS target FROM placed
  JOIN steps ON kind = CASE WHEN lower(piece) = 'p' THEN piece ELSE lower(piece) END, range(1, 8) AS d(k)
  WHERE k <= most AND square % 8 + k * f BETWEEN 0 AND 7 AND square // 8 + k * r BETWEEN 0 AND 7),
stops AS (SELECT x.id, x.square, f, r, min(k) AS stop FROM rays x JOIN placed y ON x.id = y.id AND x.target = y.square GROUP BY ALL),
hits AS (SELECT x.*, piece = upper(piece) AS white FROM rays x LEFT JOIN stops USING (id, square, f, r) WHERE k <= coalesce(stop, 7)),
sides AS (SELECT id, white, count(DISTINCT target) AS attacked, count(DISTINCT target) FILTER ((target >= 32) = white) AS controlled FROM hits GROUP BY id, white),
takes AS (SELECT h.id, h.white, sum(CASE WHEN lower(h.piece) = 'p' AND target // 8 IN (0, 7) THEN 4 ELSE 1 END) AS captures
  FROM hits h JOIN placed y ON h.id = y.id AND h.target = y.square AND (y.piece = upper(y.piece)) <> h.white GROUP BY ALL),
loose AS (SELECT p.id, count(*) AS hanging FROM placed p WHERE EXISTS (FROM hits h WHERE h.id = p.id AND h.target = p.square AND h.white <> (p.piece = upper(p.piece)))
  AND NOT EXISTS (FROM hits h WHERE h.id = p.id AND h.target = p.square AND h.white = (p.piece = upper(p.piece))) GROUP BY p.id)
SELECT b.id, {', '.join(f'CAST(coalesce({s[0]}s.{c}, 0) AS INTEGER) AS {s}_{c}' for s in ('white', 'black') for c in ('attacked', 'controlled'))},
  CAST(coalesce(wt.captures, 0) AS INTEGER) AS white_captures, CAST(coalesce(bt.captures, 0) AS INTEGER) AS black_captures, CAST(coalesce(hanging, 0) AS INTEGER) AS hanging
FROM (SELECT DISTINCT id FROM placed) b LEFT JOIN sides ws ON ws.id = b.id AND ws.white LEFT JOIN sides bs ON bs.id = b.id AND NOT bs.white
LEFT JOIN takes wt ON wt.id = b.id AND wt.white LEFT JOIN takes bt ON bt.id = b.id AND NOT bt.white LEFT JOIN loose l ON l.id = b.id"""

#: Two books: the second names some lines anew.
BOOKS = [
    [("C20", "King's pawn", "e2e4"), ("C60", "Spanish", "e2e4 e7e5 g1f3 b8c6 f1b5"), ("B90", "Najdorf", "e2e4 c7c5 g1f3 d7d6 d2d4 c5d4 f3d4 g8f6 b1c3 a7a6"), ("D30", "Queen's gambit", "d2d4 d7d5 c2c4"), ("A20", "English", "c2c4 e7e5")],
    [("C84", "Closed Spanish", "e2e4 e7e5 g1f3 b8c6 f1b5 a7a6 b5a4 g8f6 e1g1 f8e7"), ("D06", "Queen's gambit of the other book", "d2d4 d7d5 c2c4"), ("E60", "Indian", "d2d4 g8f6 c2c4 g7g6"), ("C00", "French", "e2e4 e7e6"), ("A00", "None", "a2a3")],
]


def deepest_openings(lines_played: DataFrame) -> DataFrame:
    spark = lines_played.sparkSession
    books = [spark.createDataFrame([(k, e, n, m.split()) for k, (e, n, m) in enumerate(book)], "at int, eco string, name string, moves array<string>") for book in BOOKS]
    return classified(lines_played, *books).select("id", "opening", "opening_eco")


_BOOK_ROWS = ", ".join("({}, '{}', '{}', '{}')".format(k, e, n.replace("'", "''"), m) for k, book in enumerate(BOOKS) for e, n, m in book)
OPENINGS_SQL = f"""WITH book(k, eco, name, line) AS (VALUES {_BOOK_ROWS}),
found AS (SELECT id, arg_max(struct_pack(name := name, eco := eco), length(line) * 10 + k) AS e FROM lines_played JOIN book ON starts_with(trim(moves) || ' ', line || ' ') GROUP BY id)
SELECT g.id, coalesce(e.name, '') AS opening, coalesce(e.eco, '') AS opening_eco FROM lines_played g LEFT JOIN found USING (id)"""


def listed_moves(searches: DataFrame) -> DataFrame:
    return searches.select("id", F.posexplode(move_tokens(F.col("sf_pv"))).alias("at", "move"))


MOVES_SQL = "SELECT id, CAST(unnest(range(len(m))) AS INTEGER) AS at, unnest(m) AS move FROM (SELECT id, CAST(from_json(sf_pv, '[\"VARCHAR\"]') AS VARCHAR[]) AS m FROM searches WHERE sf_pv IS NOT NULL) AS q"


def option_lines(part: DataFrame) -> DataFrame:
    line = F.concat(F.lit("option name "), "p_brand", F.lit(" Size type spin default "), F.col("p_size").cast("string"), F.lit(" min 1 max "), (F.col("p_size") * 4).cast("string"))
    lines = part.select("p_partkey", line.alias("line"))
    return reports.options(lines.select("line").distinct()).select("name", "type", "default", "min", "max")


OPTIONS_SQL = "SELECT DISTINCT p_brand || ' Size' AS name, 'spin' AS type, CAST(p_size AS VARCHAR) AS \"default\", '1' AS min, CAST(p_size * 4 AS VARCHAR) AS max FROM part"


# further rows of reports


def scatter(name: str, columns: list[str], n: int, rule: str | None = None) -> tuple[Callable[[DataFrame], DataFrame], str]:
    """A repeatable sample of searches and its SQL; ``columns`` are names of report rows."""
    source = {"total_time_ms": "time_ms", "total_nodes": "nodes + qnodes", "total_tt_stores": "tt_stores", "total_tt_hits": "tt_hits", "search_id": "id"}
    rules = [f"{c} IS NOT NULL" for c in columns] + ([rule] if rule else [])

    def run(searched: DataFrame) -> DataFrame:
        return sample_rows(searched.where(" AND ".join(rules)).select("search_id", *columns), ["search_id"], n)

    picked = ", ".join(f"{source.get(c, c)} AS {c}" for c in ["search_id", *columns])
    return run, f"SELECT * FROM (SELECT {picked} FROM searches) AS s WHERE {' AND '.join(rules)} ORDER BY md5('42|' || CAST(search_id AS VARCHAR)), search_id LIMIT {n}"


def linked_histogram(metric: str, step: float) -> tuple[Callable[[DataFrame], DataFrame], str]:
    """The histogram of ``metric`` under the ranges of the two other linked charts."""
    ranges = {"depth": ("depth", 3, 20), "total_nodes": ("nodes + qnodes", 100, 1500), "total_time_ms": ("time_ms", 250, 1250)}

    def run(searched: DataFrame) -> DataFrame:
        rules = {name: F.col(name).between(low, high) for name, (_, low, high) in ranges.items()}
        return views.histogram(views.crossfiltered(searched, rules, metric), metric, step)

    others = " AND ".join(f"{sql} BETWEEN {low} AND {high}" for name, (sql, low, high) in ranges.items() if name != metric)
    own = ranges[metric][0]
    return run, f"SELECT floor(({own}) / {step}.0) * {step} AS bin, count(*) AS count FROM searches WHERE {others} AND ({own}) IS NOT NULL GROUP BY 1"


def compare_summary(searched: DataFrame) -> DataFrame:
    return views.summary(searched, total=F.count("*"), n_engines=F.count_distinct("engine_id"), avg_depth=F.avg("completed_depth"), avg_nodes=F.avg("total_nodes"), avg_time=F.avg("total_time_ms"))


COMPARE_SQL = "SELECT count(*) AS total, count(DISTINCT engine_id) AS n_engines, avg(completed_depth) AS avg_depth, avg(nodes + qnodes) AS avg_nodes, avg(time_ms) AS avg_time FROM searches"
_FH_DEPTH = ", ".join(f"avg(CAST(fh_index_{b} AS DOUBLE) / NULLIF(CAST(fail_highs AS DOUBLE), 1)) AS idx{b}" for b in FH_BUCKETS)
FH_SQL = f"SELECT completed_depth AS depth, {_FH_DEPTH} FROM searches WHERE fh_index_0 IS NOT NULL AND fail_highs <> 1 AND completed_depth BETWEEN 1 AND 25 GROUP BY 1"


def add_all(add: Callable[..., None]) -> None:
    """Registers the queries with the catalogue's ``add``."""
    add("S14_ranked_ids", ranked_orders, "SELECT o_orderkey, 10 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
    add("U26_running_total", running_orders, "SELECT o_orderkey, CAST(sum(o_custkey) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM orders")
    add("U26_paired_statistics", paired_statistics, PAIRED_SQL, "wilcoxon t ks")
    add("G01_S10_incremental_load", incremental_load, TIMINGS_SQL, "total_time_ms")
    add("G03_late_arrivals", late_arrivals, TIMINGS_SQL, "total_time_ms")
    add("G04_late_children", late_children, TIMINGS_SQL, "total_time_ms")
    add("S16_S18_merged_range", merged_range, MERGED_SQL)
    add("S10_S13_pinned_versions", pinned_versions, VERSIONS_SQL)
    add("U05_board_cells", board_cells, CELLS_SQL)
    add("U06_U07_material", material, MATERIAL_SQL)
    add("S01_S35_log_intake", log_intake, INTAKE_SQL)
    add("S25_suite_records", suite_records, SUITE_SQL)
    add("F05_report_statistics", report_statistics, STATISTICS_SQL, "total first highs lows q_ratio")
    add("F07_match_logs", match_logs, MATCHES_SQL, "llr")
    add("S23_U03_book_games", book_games, BOOKS_SQL)
    add("U32_perft_counts", perft_counts, PERFT_SQL)
    add("U10_U12_attacks", attacks, ATTACKS_SQL)
    add("U01_U04_deepest_openings", deepest_openings, OPENINGS_SQL)
    add("U02_move_tokens", listed_moves, MOVES_SQL)
    add("U31_option_lines", option_lines, OPTIONS_SQL)
    add("D16_compare_summary", compare_summary, COMPARE_SQL, "avg_depth avg_nodes avg_time")
    for name, columns, n, rule in (
        ("D06_depth_scatter", ["depth", "total_nodes", "engine_id"], 3000, None),
        ("D16_table_hits", ["total_tt_stores", "total_tt_hits", "engine_id"], 3000, None),
        ("D37_time_nodes_scatter", ["total_time_ms", "total_nodes"], 3000, None),
        ("D41_eval_scatter", ["eval", "sf_eval"], 3000, "abs(eval) < 1000 AND abs(sf_eval) < 1000"),
    ):
        add(name, *scatter(name, columns, n, rule), "total_time_ms" if "total_time_ms" in columns else "")
    for metric, step in (("depth", 4), ("total_nodes", 200), ("total_time_ms", 250)):
        add(f"D06_linked_{metric}", *linked_histogram(metric, step), "bin")
    add("D21_nmp_by_depth", lambda iterations: views.averaged(iterations, "depth", "nmp", "nmp_failhigh"), "SELECT depth, avg(nmp) AS nmp, avg(nmp_failhigh) AS nmp_failhigh FROM iterations GROUP BY depth", "nmp nmp_failhigh")
    add("D22_prunes_by_ply", lambda tree: views.averaged(tree, "depth", "see_prunes", "delta_prunes", "nmp"), "SELECT depth, avg(see_prunes) AS see_prunes, avg(delta_prunes) AS delta_prunes, avg(nmp) AS nmp FROM tree GROUP BY depth", "see_prunes delta_prunes nmp")
    add("D26_fail_high_by_completed_depth", lambda searched: views.fail_high_by_depth(searched, "completed_depth", 25), FH_SQL, " ".join(f"idx{b}" for b in FH_BUCKETS))
    add(
        "D39_root_moves_sample",
        lambda root_moves: sample_rows(root_moves.where("eval IS NOT NULL AND time_ms IS NOT NULL"), ["search_id", "depth", "move", "nodes", "eval", "time_ms"], 5000),
        "SELECT * FROM root_moves WHERE eval IS NOT NULL AND time_ms IS NOT NULL ORDER BY md5(concat_ws('|', '42', search_id, depth, move, nodes, eval, time_ms)), search_id, depth, move, nodes, eval, time_ms LIMIT 5000",
    )
