"""Operators on literal rows, chess rules, readers, warehouse, streams."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyspark.chesscore.rules import START, Position, legal_prefix, perft, read_move
from plyspark.functions import elo, safe
from plyspark.functions.paired import paired_tests, rank_sum_exact, t_two_sided
from plyspark.operators import match, order, positions, quality, search
from plyspark.plans import warehouse
from plyspark.schemas import GAME_LOG, ROOT_MOVES_LOG, SEARCH_LOG
from plyspark.sources import logs, reports
from plyspark.sources import positions as suites
from plyspark.streaming import live

KIWI = "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1"


def one(df):
    return df.first()[0]


def test_division_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (3.0, 1.0), (3.0, 2.0), (None, 2.0)], "p double, w double")
    rows = df.select(safe.ratio("p", "w"), safe.divided("p", "w"), safe.ratio_not_one("p", "w"), safe.guarded("p", "w")).collect()
    assert [r[0] for r in rows] == [None, None, None, 3.0, 1.5, None]
    assert rows[0][1] == math.inf and math.isnan(rows[1][1]) and rows[2][1] == -math.inf
    assert rows[0][2] == math.inf and rows[3][2] is None and rows[4][2] == 1.5
    assert [r[3] for r in rows] == [None, None, None, 3.0, 1.5, None]


def test_codes_paths_and_arrays(spark):
    df = spark.createDataFrame([("1", "a\\b\\c", [7, None]), ("1-0", "x", []), (None, None, None)], "c string, p string, a array<int>")
    rows = df.select(safe.decoded("c", {1: "white"}), safe.last_part("p"), safe.at_or_zero("a", 0), safe.at_or_zero("a", 1), safe.at_or_zero("a", 2)).collect()
    assert [tuple(r) for r in rows] == [("white", "c", 7, None, 0), (None, "x", 0, 0, 0), (None, None, None, None, None)]


def test_islands_share_a_group_and_runs_do_not(spark):
    moves = ["a", "b", "a", "a", "b", "b"]
    zero = {c: F.lit(1) for c in search.COUNTERS}
    df = spark.createDataFrame([(1, k + 1, m, 10 * (k + 1), 5 - 3 * k, 2 * k) for k, m in enumerate(moves)], "search_id long, depth long, move string, time_ms int, eval int, nodes int").withColumns(zero | {"qnodes": F.lit(0), "qdepth": F.lit(0), "fail_high_researches": F.lit(0), "fail_low_researches": F.lit(0)})
    rows = sorted(search.iteration_features(df).collect(), key=lambda r: r.depth)
    assert [r.move_stability for r in rows] == [0, 0, 1, 2, 0, 1] and [r.move_run_length for r in rows] == [0, 0, 0, 1, 0, 1]
    assert rows[0].stddev_eval is None and rows[1].ebf == math.inf and rows[2].ebf == 2.0 and rows[3].running_time_ms == 100
    assert [r.eval_sign_flips for r in rows] == [0, 0, 1, 0, 0, 0]


def test_last_known_skips_null_and_geometric_means(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 100.0), (4, None)], "depth int, v double")
    assert one(df.agg(safe.latest_known("v", "depth"))) == 100.0
    assert one(df.agg(safe.geo_mean("v", natural=False))) == pytest.approx(math.exp((math.log10(5) + 2) / 4))
    assert one(df.where("v > 0").agg(safe.geo_mean("v"))) == pytest.approx(math.sqrt(500))


def test_orphans_follow_not_in(spark):
    child = spark.createDataFrame([(1,), (2,), (9,), (None,)], "k long")
    parents = lambda *v: spark.createDataFrame([(x,) for x in v], "id long")
    n = lambda *v: quality.orphans(child, "k", parents(*v), "V").first().n
    assert n(1, 2) == 1 and n(1, 2, None) == 0 and n() == 4 and n(9, 9) == 2


@pytest.mark.parametrize("score", [0.01, 0.3, 0.5, 0.77, 0.99])
def test_elo_round_trip(spark, score):
    assert one(spark.range(1).select(elo.elo_to_score(elo.score_to_elo(F.lit(score))))) == pytest.approx(score)


def test_ratings_at_the_edges(spark):
    df = spark.createDataFrame([(0, 0, 0), (5, 0, 0), (0, 5, 0), (0, 0, 5), (30, 40, 10)], "w int, d int, l int")
    w, d, losses = F.col("w"), F.col("d"), F.col("l")
    rows = df.select(elo.elo_interval(w, d, losses).elo, elo.log_likelihood_ratio(w, d, losses, 0, 10), elo.elo_difference(w, losses, d), elo.likelihood_of_superiority(w, losses).los, elo.normalized_elo_interval(w, d, losses).elo, elo.bayes_elo_interval(w, d, losses).elo, elo.match_score(w, d, losses)).collect()
    assert rows[0][0] == 0 and rows[0][1] == 0 and rows[0][2] is None and rows[0][3] == 50 and rows[0][6] == 0.5
    assert rows[1][0] == 800 and rows[1][2] == 800 and rows[3][2] == -800 and rows[2][3] == 50
    assert rows[4][1] > 0 and rows[3][1] < 0 and rows[4][3] > 98 and rows[1][4] == 0 and rows[4][5] > 0
    tc = spark.createDataFrame([("10+0.1",), ("1:30+1",), ("3:00",), ("600",), ("60:00+30",), ("junk",)], "t string").select(elo.time_control_class(F.col("t"))).collect()
    assert [r[0] for r in tc] == ["ultra_fast", "blitz", "blitz", "rapid", "classical", None]


def test_pairs_and_performance(spark):
    games = spark.createDataFrame([("r", k + 1, o) for k, o in enumerate("wwlwddl")], "run string, game_num long, outcome string")
    assert {r.kind: r.n for r in match.game_pairs(games, "run").collect()} == {"ww": 1, "lw": 1, "dd": 1}
    assert match.pair_scores(games, "run").first().score == pytest.approx(4 / 6)
    results = spark.createDataFrame([(1, 5, 0, 5, 1500.0), (1, 5, 0, 5, 1500.0), (2, 3, 0, 0, 1400.0), (3, 0, 0, 0, 1.0)], "candidate long, wins long, draws long, losses long, opponent_elo double")
    assert {r.candidate: (r.rating, r.games) for r in match.performance_ratings(results).collect()} == {1: (1500.0, 20), 2: (2200.0, 3)}
    played = spark.createDataFrame([("a", "b", "1-0"), ("b", "a", "0-1"), ("a", "c", "1/2-1/2"), ("a", "b", "?")], "white string, black string, result string")
    assert {(r.name, r.opponent): (r.wins, r.draws, r.losses) for r in match.pairwise(played).collect()} == {("a", "b"): (2, 0, 0), ("b", "a"): (0, 0, 2), ("a", "c"): (0, 1, 0), ("c", "a"): (0, 1, 0)}
    deltas = match.elo_deltas(spark.createDataFrame([("a", "b", 1, 0, 0, 1500.0, 1500.0)], "name string, opponent string, wins int, draws int, losses int, rating double, opponent_rating double"))
    assert {r.name: r.delta for r in deltas.collect()} == {"a": 16.0, "b": -16.0}


def test_paired_tests(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(0.4, 1, 30)
    rows = [(float(x), 0.0) for x in a] + [(float("nan"), 1.0), (None, 2.0)]
    found = paired_tests(spark.createDataFrame(rows, "a double, b double"), "a", "b")
    t = a.mean() / (a.std(ddof=1) / math.sqrt(30))
    assert found["summary"]["n"] == 30 and found["ttest_rel"][0] == pytest.approx(t) and 0 < found["ttest_rel"][1] < 1
    ranks = np.argsort(np.argsort(np.abs(a))) + 1
    assert found["wilcoxon"][0] == min(ranks[a > 0].sum(), ranks[a < 0].sum())
    assert found["ks_2samp"][0] == pytest.approx(max((a > 0).mean(), (a < 0).mean()))
    # tabulated values: t = 2.045 at 29 degrees of freedom, W = 8 of 10 pairs
    assert t_two_sided(2.045230, 29) == pytest.approx(0.05, abs=1e-6) and rank_sum_exact(8, 10) == pytest.approx(0.0488, abs=1e-4)
    assert t_two_sided(0.0, 5) == 1.0 and paired_tests(spark.createDataFrame([], "a double, b double"), "a", "b")["ttest_rel"] is None


def test_ranks_and_totals_over_ranges(spark):
    rows = [(k * 37 % 101, k % 7) for k in range(100)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    total, want = 0, {}
    for k, v in sorted(rows):
        total += v
        want[k] = total
    assert {r.k: r.t for r in order.running_total(df, ["k"], "v", "t").collect()} == want
    assert [r.id for r in order.ranked(df, ["k"], start=10).orderBy("k").collect()] == list(range(11, 111))
    assert order.ranked(df.limit(0), ["k"]).count() == 0
    assert set(order.ranked(df.withColumnRenamed("v", "_range"), ["k"]).columns) == {"k", "_range", "id"}


def test_ranks_over_many_shuffled_partitions(spark, tmp_path):
    """Wide rows whose ranges adaptive execution coalesces by size, in several files, twice."""
    n, old = 60_000, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("wide")).repartition(6).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        for _ in range(2):
            assert order.ranked(rows, ["k"]).where("id <> k + 1").count() == 0
        total = order.running_total(rows.withColumn("one", F.lit(1)), ["k"], "one", "t")
        assert total.where("t <> k + 1").count() == 0 and total.count() == n
        # the signed-rank statistic of pairs over as many ranges
        pairs = rows.select((F.col("k") * 31 % 10_007 - 4_000).cast("double").alias("a"), F.lit(0.0).alias("b"))
        d = np.array([r.a for r in pairs.collect()])
        d = d[d != 0]
        by = np.argsort(np.abs(d), kind="stable")
        _, first, count = np.unique(np.abs(d)[by], return_index=True, return_counts=True)
        rank = np.empty(len(d))
        rank[by] = np.repeat(first + (count + 1) / 2, count)
        assert paired_tests(pairs, "a", "b")["wilcoxon"][0] == pytest.approx(min(rank[d > 0].sum(), rank[d < 0].sum()))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_filters_see_the_other_clients(spark):
    from plyspark.plans import views

    df = spark.range(10)
    preds = {"a": F.col("id") > 3, "b": F.col("id") < 8}
    assert [views.crossfiltered(df, preds, c).count() for c in ("a", "b", "none")] == [8, 6, 4]
    assert views.counted(df, F.col("id") % 3, "m", 2).collect() == [(0, 4), (1, 3)]
    assert [safe.sample_rows(df, ["id"], 4).collect() for _ in range(2)][0] == safe.sample_rows(df.repartition(3), ["id"], 4).collect()
    assert [r[0] for r in df.where("id > 7").select(safe.compact(F.col("id") * 1250)).collect()] == ["10.0K", "11.3K"]


# chess


@pytest.mark.parametrize("fen, depth, nodes", [(START, 3, 8902), (KIWI, 2, 2039), ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", 3, 2812), ("r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", 3, 9467), ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", 2, 1486)])
def test_perft(fen, depth, nodes):
    assert perft(Position(fen), depth) == nodes


def test_move_text():
    p = Position(KIWI)
    assert read_move(p, "O-O").uci == "e1g1" and read_move(p, "dxe6").uci == "d5e6" and read_move(p, "Nxg6").uci == "e5g6" and read_move(p, "Nb5+?!").uci == "c3b5" and read_move(p, "Ke3") is None
    assert read_move(Position("8/P6k/8/8/8/8/8/K7 w - - 0 1"), "a8=Q").uci == "a7a8q"
    two = Position("4k3/8/8/8/8/8/8/RK5R w - - 0 1")
    assert read_move(two, "Rhe1").uci == "h1e1" and Position(START).legal_moves()[0]
    assert legal_prefix(["e4", "e7e5", "Nf3", "zz", "Nc6"]) == ["e2e4", "e7e5", "g1f3"]


def test_position_features(spark):
    rows = [(1, 1, START), (2, 1, KIWI), (3, 2, "not a fen"), (4, 2, None), (5, 2, "8/8/4k3/8/3PP3/8/4K3/8 w - - 0 40"), (6, 3, START)]
    df = spark.createDataFrame(rows, "search_id long, game_id long, fen string")
    got = {r.search_id: r for r in positions.position_features(df).collect()}
    assert set(got) == {1, 2, 3, 5, 6} and got[3].position_type == "Unknown" and got[3].white_num_moves is None
    s = got[1]
    assert (s.game_phase, s.balance, s.white_num_moves, s.black_num_moves, s.white_shield_pawns, s.white_open_files, s.white_passed, s.white_backwards) == ("opening", 0, 20, 20, 3, 0, 0, 8)
    k = got[2]
    assert k.white_num_moves == 48 and k.white_capture_ratio == pytest.approx(8 / 48, rel=1e-6) and k.balance == 0 and k.black_doubled == 0
    e = got[5]
    assert e.game_phase == "endgame" and e.position_type == "Endgame" and (e.white_passed, e.black_passed) == (2, 0) and e.white_tropism == pytest.approx(10000 / 4) and e.black_tropism == pytest.approx(10000 / 4 + 1 / 3 + 1 / 2)
    assert positions.position_features(df, done=df.where("search_id < 5")).count() == 2
    whites = spark.createDataFrame([("cp", 30, True), ("cp", 30, False), ("mate", 2, False), ("mate", -1, True)], "k string, v int, w boolean").select(positions.white_centipawns(F.col("k"), F.col("v"), F.col("w"))).collect()
    assert [r[0] for r in whites] == [30, -30, -100_000, -100_000]
    assert one(spark.createDataFrame([(START, 2)], "f string, d int").select(positions.perft_nodes("f", "d"))) == 400
    assert one(spark.createDataFrame([(START, ["e4!", "f6", "Nf3,", "g8f6"])], "f string, m array<string>").select(positions.moves_in("f", "m"))) == ["e2e4", "g1f3"]


# readers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


SEARCH_A = {"search_uuid": "s1", "game_uuid": "g1", "engine_id": "v1", "fen": START, "best_move": "e2e4", "time_ms": 10.0, "nodes": 9, "qnodes": 1, "fail_high_index": [4, 3], "principal_variation": ["e2e4"], "itdepth_nodes": [1, 8], "itdepth_eval": [5], "itdepth_move": ["e2e4", "d2d4"], "itdepth_fh_index": [[1, 2, 3, 4, 5, 6]], "treedepth_nodes": [2, 2, 2]}


def test_logs_to_tables(spark, tmp_path):
    d = str(tmp_path / "logs")
    games = [{"game_uuid": "g1", "engine_id": "v2", "side": "white", "result": 1, "moves": ["e2e4"]}, {"game_uuid": "g1", "engine_id": "v1", "side": "black"}, {"game_uuid": "g2", "engine_id": "v1"}]
    write(f"{d}/game.jsonl", "\n".join(map(json.dumps, games)) + "\n\n{broken\n[1, 2]\n")
    write(f"{d}/search.jsonl", "\n".join(map(json.dumps, [SEARCH_A, {**SEARCH_A, "search_uuid": "s2", "engine_id": "dev"}, {**SEARCH_A, "search_uuid": "s3", "game_uuid": "g9", "itdepth_nodes": []}, {**SEARCH_A, "search_uuid": "s4", "engine_id": "v8"}])) + "\n")
    write(f"{d}/timing.jsonl", json.dumps({"type": "timing", "search_uuid": "s1", "fen": "x", "ROOT": {"total_ms": 5.5, "calls": 2}, "SEE": {"calls": 1}}) + "\n" + json.dumps({"type": "other", "search_uuid": "s1", "ROOT": {}}))
    write(f"{d}/root_moves.jsonl", json.dumps({"search_uuid": "s1", "moves": [{"move": "a", "eval": 3}, {"nodes": 2}]}))
    engines = spark.createDataFrame([(11, "v1"), (12, "v2")], "id long, version string")
    rows, bad = logs.json_lines(spark, f"{d}/game.jsonl", GAME_LOG)
    assert rows.count() == 3 and bad.count() == 2
    g = {r.game_uuid: r for r in logs.games(rows, engines, start=100, second_engine=99).collect()}
    assert (g["g1"].id, g["g1"].white_engine_id, g["g1"].black_engine_id, g["g1"].result, g["g1"].moves) == (101, 12, 11, "1", '["e2e4"]')
    assert (g["g2"].white_engine_id, g["g2"].black_engine_id) == (99, 11)
    found = logs.searches(logs.json_lines(spark, f"{d}/search.jsonl", SEARCH_LOG)[0], engines, logs.games(rows, engines))
    assert logs.reconciled(logs.line_count(spark, f"{d}/search.jsonl"), found) and found.skipped.count() == 2
    s = {r.search_uuid: r for r in found.searches.collect()}
    assert s["s1"].game_id == 1 and s["s3"].game_id is None and [s["s1"][f"fh_index_{b}"] for b in search.FH_BUCKETS] == [4, 3, 0, 0, 0, 0]
    it = sorted((r.search_id, r.depth, r.nodes, r.eval, r.move, r.fh_index_8plus) for r in found.iterations.collect())
    assert it == [(s["s1"].id, 1, 1, 5, "e2e4", 6), (s["s1"].id, 2, 8, 0, "d2d4", None)] and found.tree.count() == 6
    t = {r.function: (r.total_time_ms, r.num_calls) for r in logs.timings(spark, f"{d}/timing.jsonl", found.searches).collect()}
    assert t == {"ROOT": (5.5, 2), "SEE": (0.0, 1)}
    m = logs.root_moves(logs.json_lines(spark, f"{d}/root_moves.jsonl", ROOT_MOVES_LOG)[0], found.searches).collect()
    assert sorted((r.move_index, r.move, r.eval, r.depth) for r in m) == [(0, "a", 3, 0), (1, "", None, 0)]


def test_suites_books_and_reports(spark, tmp_path):
    write(str(tmp_path / "e/x.epd"), f'# c\n\n{" ".join(KIWI.split()[:4])} bm Nxg6 O-O; id "K.1"; ce "x"; c0 "Nxg6=10";\n8/8/4k3/8/3PP3/8/4K3/8 w - - am e5 ; id "E";\nshort line\n')
    rows = {r.id: r for r in suites.epd(spark, str(tmp_path / "e")).collect()}
    assert rows["K.1"].expected == ["Nxg6", "O-O"] and rows["K.1"].fen == KIWI and rows["K.1"].ce is None and rows["K.1"].c0 == "Nxg6=10" and rows["E"].avoid == ["e5"] and len(rows) == 2
    write(str(tmp_path / "b.pgn"), '{about\n[ECO "no"]}\n\n[ECO "B00"]\n[Opening "King\'s pawn"]\n\n1. e4 *\n\n[ECO "C20"]\n[Opening "Open"]\n[Variation "v"]\n\n1. e4 e5 2. Nf3 *\n')
    book = suites.pgn_openings(spark, str(tmp_path / "b.pgn"))
    assert sorted((r.eco, r.name, tuple(r.moves)) for r in book.collect()) == [("B00", "King's pawn", ("e2e4",)), ("C20", "Open", ("e2e4", "e7e5", "g1f3"))]
    games = spark.createDataFrame([(1, '["e4","e5","Nf3","Nc6"]'), (2, "e2e4 e7e5"), (3, "d4"), (4, None), (5, "e4 e5 Nf3")], "id long, moves string")
    assert {r.id: (r.opening_eco, r.opening) for r in suites.classified(games, book).collect()} == {1: ("C20", "Open"), 2: ("B00", "King's pawn"), 3: ("", ""), 4: ("", ""), 5: ("C20", "Open")}
    write(str(tmp_path / "p.txt"), f"# c\n{KIWI} | Kiwi\n\n{START}\n")
    assert [r.name for r in suites.named_positions(spark, str(tmp_path / "p.txt")).collect()] == ["Kiwi", START[:40]]
    write(str(tmp_path / "m.txt"), "Score of Candidate vs B: 1 - 0 - 0 [1.0] 1\nFinished game 1 (Candidate vs B): 1-0 {x}\nFinished game 2 (B vs Candidate): 1/2-1/2 {x}\nScore of Candidate vs B: 3 - 1 - 2 [0.6] 6\n... Candidate playing White: 2 - 0 - 1\nElo difference: inf +/- nan, LOS: 97.5 %, DrawRatio: 33.3 %\nSPRT: llr 3.1 (105%), lbound -2.94, ubound 2.94\n")
    lines = reports.lines_of(spark, str(tmp_path / "m.txt"))
    r = reports.match_report(lines).first()
    assert (r.candidate_wins, r.candidate_losses, r.candidate_draws, r.games_played, r.candidate_white_wins, r.elo_diff, r.los, r.result) == (3, 1, 2, 6, 2, None, 97.5, "pass")
    assert [(x.white, x.result) for x in reports.finished_games(lines).orderBy("at").collect()] == [("Candidate", "1-0"), ("B", "1/2-1/2")]
    write(str(tmp_path / "s.txt"), "Completed Depth  9\nNPS 1000\nTotal 200\nQNodes 50\nFH % at [0] 71.5%\nD  Eval  Move Time Nodes\n----\n1  10 e2e4 1 20\n2 -5 d2d4 3 60\n")
    stats = reports.statistics(spark.read.text(str(tmp_path / "s.txt"), wholetext=True).withColumnRenamed("value", "text"))
    st = stats.first()
    of = lambda *labels: tuple(spark.createDataFrame([st], stats.schema).select(*[reports.labelled(F.col("statistics"), x).alias(x) for x in labels]).first())
    assert of("Completed Depth", "Total", "FH % at [0]", "Fail Lows") == (9.0, 200.0, 71.5, None) and st.q_ratio == 25.0
    assert [(x.depth, x.eval, x.nodes) for x in reports.depth_table(reports.lines_of(spark, str(tmp_path / "s.txt"))).collect()] == [(1, 10, 20)]
    opt = reports.options(spark.createDataFrame([("option name Hash Size type spin default 16 min 1 max 64",), ('option name Path type string default "a b"',), ("uciok",)], "line string")).collect()
    assert [(o.name, o.default, o.max) for o in opt] == [("Hash Size", "16", "64"), ("Path", "a b", None)]
    m = F.create_map(F.lit("hash size"), F.lit("16.7"), F.lit("PONDER"), F.lit("On"))
    got = spark.range(1).select(reports.option_value(m, "Hash_Size"), reports.option_value(m, "hash_size", "double", 100), reports.option_value(m, "ponder", "boolean"), reports.option_value(m, "x")).first()
    assert got[0] == 16 and got[1] == pytest.approx(0.167) and tuple(got)[2:] == (True, None)


# warehouse


def raw_store(spark, root, ids):
    raw = warehouse.Store(spark, root)
    n = spark.createDataFrame([(i,) for i in ids], "id long")
    counters = {c: (F.col("id") % (k + 2)).cast("long") for k, c in enumerate([*search.COUNTERS, "fail_high_researches", "fail_low_researches", "tt_overwritten"])}
    base = {"engine_id": F.col("id") % 3, "game_id": F.lit(1), "sts_id": F.lit(1), "fen": F.lit(START), "ply": F.lit(1), "time_ms": F.col("id") * 1.0, "eval": F.col("id") - 3, "completed_depth": F.lit(4), "depth": F.lit(8), "qdepth": F.lit(9), "move": F.lit("e2e4"), "principal_variation": F.lit("[]"), "nodes": F.col("id") * 10, "qnodes": F.col("id") * 3}
    raw.write("searches", n.withColumns(base | counters))
    child = n.select(F.col("id").alias("search_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("depth"))
    same = {c: (F.col("depth") % (k + 2)).cast("long") for k, c in enumerate([*search.COUNTERS, "fail_high_researches", "fail_low_researches"])}
    raw.write("searches_by_iteration", child.withColumns(same | {"qdepth": F.lit(1), "time_ms": F.col("depth") * 1.0, "eval": F.col("depth") - 2, "move": F.lit("m"), "nodes": F.col("depth") * 7, "qnodes": F.col("depth") * 2}))
    raw.write("searches_by_tree_depth", child.withColumns({**{c: same[c] for c in search.COUNTERS}, "nodes": F.col("depth") * 5, "qnodes": F.col("depth")}))
    raw.write("timing", n.select(F.col("id").alias("search_id"), F.lit("SEE").alias("function"), F.lit(2.0).alias("total_time_ms"), F.lit(4).cast("long").alias("num_calls")))
    raw.write("engines", spark.createDataFrame([(1, "a", "v1"), (2, "b", "v2")], "id long, name string, version string"))
    raw.write("games", spark.createDataFrame([(1, 1, 2, "1", "5", "e4 e5", "", 3.0)], "id long, white_engine_id long, black_engine_id long, result string, termination string, moves string, opening string, run_time_s double"))
    raw.write("sts", spark.createDataFrame([(1, "C:\\x\\s.epd", "A - b", True)], "id long, suite string, position_name string, move_is_correct boolean"))
    raw.write("sprt", spark.createDataFrame([(1, "0.05", "0.05", "b\\c.pgn", 0.0, 10.0, 33.0)], "id long, alpha string, beta string, opening_book string, elo0 double, elo1 double, elo_diff double"))
    raw.write("engine_ratings", spark.createDataFrame([(1, 2, 1500.5, 8)], "id long, engine_id long, elo_blitz double, games_blitz long"))
    return raw


def test_incremental_equals_full(spark, tmp_path):
    features = ["search_tree_features", "search_iteration_features", "search_features"]
    first, whole = raw_store(spark, str(tmp_path / "r1"), range(1, 6)), raw_store(spark, str(tmp_path / "r2"), range(1, 10))
    step, full = warehouse.Store(spark, str(tmp_path / "a1")), warehouse.Store(spark, str(tmp_path / "a2"))
    book = spark.createDataFrame([(0, "B00", "King's pawn", ["e2e4"])], "at long, eco string, name string, moves array<string>")
    for raw, to in ((first, step), (whole, step), (whole, full)):
        warehouse.load(raw, to, full=to is full, book=book)
        if not to.exists("position_features"):
            to.write("position_features", positions.position_features(spark.createDataFrame([(1, 1, KIWI)], "search_id long, game_id long, fen string")))
        warehouse.build_features(to, full=to is full)
    for t in [*features, "search_stats", "game_stats"]:
        a, b = step.read(t), full.read(t).select(step.read(t).columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, t
    g = full.read("game_stats").first()
    assert (g.result, g.termination, g.opening, g.opening_eco) == ("white", "time", "King's pawn", "B00")
    r = full.read("sprt_runs").first()
    assert (r.opening_book, r.elo_diff, r.measured_elo_diff, r.alpha) == ("c.pgn", 10.0, 33.0, 0.05)
    assert full.read("engine_ratings").first().elo_blitz == 1500 and full.read("sts_runs").first().position_type == "b"
    assert [x.message for x in warehouse.contract(full).where("severity = 'error'").collect()] == []
    assert "error" in {x.severity for x in warehouse.contract(warehouse.Store(spark, str(tmp_path / "none"))).collect()}
    late = raw_store(spark, str(tmp_path / "r3"), [0, *range(1, 10)])
    warehouse.load(late, step, late=True)
    assert step.read("search_stats").count() == 10 and step.read("searches" if step.exists("searches") else "search_stats").where("id = 0").count() == 1


def test_upserts_migrations_and_clearing(spark, tmp_path):
    old = spark.createDataFrame([(1, 1500.0, 10), (2, None, None)], "engine_id long, elo double, games long")
    new = spark.createDataFrame([(2, 1600.0, 5), (1, None, 3), (3, 1400.0, 1)], "engine_id long, elo double, games long")
    assert sorted(map(tuple, warehouse.upsert(old, new, "engine_id", add=("games",)).collect())) == [(1, 1500.0, 13), (2, 1600.0, 5), (3, 1400.0, 1)]
    store = warehouse.Store(spark, str(tmp_path / "w"))
    store.write("engines", spark.createDataFrame([(7, "v1")], "id long, version string"))
    more = warehouse.registered(store.read("engines"), spark.createDataFrame([("v1",), ("v2",), ("v3",)], "version string"))
    assert sorted((r.id, r.version) for r in more.collect()) == [(7, "v1"), (8, "v2"), (9, "v3")]
    steps = [warehouse.Migration("m1", "engines", (("note", "string", "x"),)), warehouse.Migration("m2", "engines", (("n", "int", 0),))]
    assert warehouse.migrate(store, steps, dry_run=True) == ["m1", "m2"] and store.columns("engines") == ["id", "version"]
    assert warehouse.migrate(store, steps, only="m2") == ["m2"] and warehouse.migrate(store, steps) == ["m1"] and warehouse.migrate(store, steps) == []
    assert store.columns("engines") == ["id", "version", "n", "note"] and store.last_id("engines") == 7 and store.last_id("none") == 0
    store.clear(keep_engines=True)
    assert store.tables() == ["engines"]


# streams and tuning


def test_streams(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    df = spark.createDataFrame([(k, "r", "wwdl"[k % 4]) for k in range(8)], "id long, run string, outcome string")
    df.coalesce(1).write.parquet(folder)
    live.follow(spark, folder, df.schema, lambda rows, n: seen.append(rows.count()), str(tmp_path / "ck")).awaitTermination()
    df.coalesce(1).write.mode("append").parquet(folder)
    live.follow(spark, folder, df.schema, lambda rows, n: seen.append(rows.count()), str(tmp_path / "ck")).awaitTermination()
    assert seen == [8, 8]
    query = live.live_tests(spark.readStream.schema(df.schema).parquet(folder)).writeStream.outputMode("update").format("memory").queryName("tests").trigger(availableNow=True).start()
    query.awaitTermination()
    r = spark.sql("SELECT * FROM tests ORDER BY wins DESC").first()
    assert (r.wins, r.draws, r.losses, r.decision) == (8, 4, 4, "inconclusive")
    assert live.unseen(df.where("id < 4"), df.union(df), "id").count() == 4


def test_tables_of_a_database_are_read_in_parts(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/base;create=true"
    games = spark.range(1, 101).selectExpr("id", "CAST(id % 3 AS INT) AS result")
    games.write.jdbc(url, "games")
    games.limit(0).write.jdbc(url, "searches")
    store = warehouse.Store(spark, str(tmp_path / "raw"))
    warehouse.imported(store, url, {"games": "id", "searches": None})
    got = store.read("GAMES" if store.exists("GAMES") else "games")
    assert got.count() == 100 and got.rdd.getNumPartitions() > 1 and sorted(r[0] for r in got.selectExpr("id").collect()) == list(range(1, 101))
    assert store.read("searches").count() == 0


def test_smoothing_is_the_recursion(spark):
    df = spark.createDataFrame([(1, k, float(v)) for k, v in enumerate([3, 9, 1, 4])], "g long, k long, v double")
    got = [r.ema for r in match.smoothed(df, "g", "k", "v").orderBy("k").collect()]
    want = [3.0]
    for v in (9, 1, 4):
        want.append(0.2 * v + 0.8 * want[-1])
    assert got == pytest.approx(want)


def test_smoothing_in_blocks_of_blocks(spark):
    values = [float(k * 7919 % 101) for k in range(700)]
    df = spark.createDataFrame([(g, k, v) for g in (1, None) for k, v in enumerate(values)] + [(2, 5, None), (2, 6, 1.5)], "g long, k long, v double").repartition(7)
    got = match.smoothed(df, "g", "k", "v", alpha=0.01).collect()
    want = [values[0]]
    for v in values[1:]:
        want.append(0.01 * v + 0.99 * want[-1])
    for g in (1, None):
        assert [r.ema for r in sorted((r for r in got if r.g == g), key=lambda r: r.k)] == pytest.approx(want)
    assert [(r.k, r.ema) for r in got if r.g == 2] == [(6, 1.5)]
    few = spark.createDataFrame([(1, k, 0.5, 1.0) for k in range(20)], "g long, place long, factor double, term double")
    assert max(r.value for r in match.composed(few, "g", block=2).collect()) == pytest.approx(2 - 2 * 0.5**20)
