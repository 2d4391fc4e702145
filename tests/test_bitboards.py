"""Attacks by bits against attacks by rules, over positions of played games and boards of any kind."""

import random

from pyspark.sql import functions as F

from plyspark.chesscore.rules import START, Position
from plyspark.operators import bitboards

KIWI = "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1"


def played(seed, n):
    """Boards of random games, and boards that no game has."""
    rng, out = random.Random(seed), []
    while len(out) < n * 3 // 4:
        p = Position(rng.choice([START, KIWI]))
        for _ in range(60):
            out.append("".join(p.cells))
            moves = [m for m in p._candidates() if p.cells[m.to] not in "kK"]
            if not moves:
                break
            p = p.play(rng.choice(moves))
    while len(out) < n:
        density = rng.random()
        out.append("".join(rng.choice(bitboards.PIECES) if rng.random() < density else "." for _ in range(64)))
    return out[:n]


def by_rules(board):
    p = object.__new__(Position)
    p.cells, p.castling, p.passing = list(board), "-", None
    out = {}
    for side, white in (("white", True), ("black", False)):
        pairs = [(s, to) for s in range(64) if p.own(s, white) for to in p.attacks(s)]
        out[f"{side}_attacked"] = len({to for _, to in pairs})
        out[f"{side}_controlled"] = len({to for _, to in pairs if (to >= 32) == white})
        out[f"{side}_captures"] = sum(4 if p.cells[s] in "pP" and to // 8 in (0, 7) else 1 for s, to in pairs if p.own(to, not white))
    out["hanging"] = sum(c != "." and p.attacked(s, not c.isupper()) and not p.attacked(s, c.isupper()) for s, c in enumerate(board))
    return out


def test_ten_thousand_boards(spark):
    boards = sorted(set(played(7, 11_500)))
    assert len(boards) > 10_000
    rows = spark.createDataFrame([(b,) for b in boards], "board string").repartition(8)
    got = bitboards.attack_features(rows, "board").collect()
    assert len(got) == len(boards)
    for row in got:
        found = row.asDict()
        board = found.pop("board")
        assert found == by_rules(board), board


def test_boards_that_are_not_one(spark):
    row = bitboards.attack_features(spark.createDataFrame([(None,)], "board string"), "board").first()
    assert row["hanging"] is None and row["white_attacked"] is None


def test_no_python_and_no_shuffle(spark):
    plan = bitboards.attack_features(spark.createDataFrame([("." * 64,)], "board string"), "board")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_shifts_stop_at_the_edges(spark):
    cell = lambda sq: F.lit(1 << sq if sq < 63 else -(1 << 63)).cast("long")
    for sq in (0, 7, 27, 56, 63):
        for f, r in bitboards.ROOK + bitboards.BISHOP + bitboards.LEAPS:
            to = (sq % 8 + f, sq // 8 + r)
            want = 1 << (8 * to[1] + to[0]) if 0 <= to[0] < 8 and 0 <= to[1] < 8 else 0
            got = spark.range(1).select(bitboards.shifted(cell(sq), f, r)).first()[0]
            assert got % (1 << 64) == want
