"""Openings by hashes of prefixes."""

import random

import pandas as pd
from pyspark.sql import functions as F

from plyspark.chesscore import rules
from plyspark.sources import positions as source


def test_hashes_tell_prefixes_apart(spark):
    row = spark.createDataFrame([(["a", "b", "c"], ["a", "b"], ["ab", "c"], [], None)], "x array<string>, y array<string>, z array<string>, e array<string>, n array<string>")
    h = lambda c, most=9: source.prefix_hashes(F.col(c), most)
    x, y, z, e, n, two = row.select(h("x"), h("y"), h("z"), h("e"), h("n"), h("x", 2)).first()
    assert x[:2] == y == two and len(set(x)) == 3 and not set(x) & set(z) and e == [] and n is None


def test_deepest_line_of_two_books_by_hand(spark, monkeypatch):
    # any tokens are legal here, so that lines may branch at will
    monkeypatch.setattr(source, "uci_prefix", lambda tokens: tokens)
    rng = random.Random(5)
    line = lambda: [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
    books = [[(k, f"E{b}{k}", f"name {b} {k}", line()) for k in range(60)] for b in (0, 1)]
    games = [(k, " ".join(line() + line())) for k in range(300)] + [(900, ""), (901, None), (902, "z a"), (903, '["a","b"]')]
    frames = [spark.createDataFrame([*b, (99, "X", "empty", [])], "at long, eco string, name string, moves array<string>") for b in books]
    got = {r.id: (r.opening, r.opening_eco) for r in source.classified(spark.createDataFrame(games, "id long, moves string"), *frames).collect()}
    for k, moves in games:
        tokens = ["a", "b"] if k == 903 else (moves or "").split()
        held = [(len(m), b, at, name, eco) for b, book in enumerate(books) for at, eco, name, m in book if tokens[: len(m)] == m]
        assert got[k] == (max(held)[3:] if held else ("", "")), moves
    assert source.classified(spark.createDataFrame(games[:3], "id long, moves string"), frames[0].limit(0)).where("opening <> ''").isEmpty()


def test_equal_hashes_of_other_lines_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(source, "uci_prefix", lambda tokens: tokens)
    # every prefix of one length has the same hash
    monkeypatch.setattr(source, "prefix_hashes", lambda moves, most: F.transform(F.slice(moves, 1, most), lambda x, k: k.cast("long")))
    book = spark.createDataFrame([(0, "A", "one", ["a", "b"]), (1, "B", "two", ["a", "c"]), (2, "C", "three", ["a"])], "at long, eco string, name string, moves array<string>")
    games = spark.createDataFrame([(1, "a b d"), (2, "a c"), (3, "a d"), (4, "d")], "id long, moves string")
    assert [r.opening for r in source.classified(games, book).orderBy("id").collect()] == ["one", "two", "three", ""]


def test_books_are_split_at_games_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "uci_prefix", lambda tokens: F.col(tokens))
    book = 'a head [ECO "x"]\r\n\r\n[ECO "A"]\r\n[Event "one"]\r\n\r\n1. e4 {so\r\n[ECO "no"] and } e5 {tail} *\r\n\r\n[ECO "B"]\n[Opening "two"]\n\n1. d4 see [ECO "no"] d5 1-0\n[ECO "C"]\n\n{open [Opening "x"]'
    (tmp_path / "a.pgn").write_bytes(book.encode())
    (tmp_path / "b.pgn").write_bytes(b'[ECO "D"]\n[Opening "four"]\n\n1. c4 c5 *\n')
    (tmp_path / "c.pgn").write_bytes(b"no games\n")
    rows = source.pgn_openings(spark, str(tmp_path)).orderBy("at").collect()
    assert [(r.eco, r.name, " ".join(r.moves)) for r in rows] == [("A", "one", "e4 e5"), ("B", "two", "d4 see d5"), ("C", "", ""), ("D", "four", "c4 c5")]


def test_moves_are_read_once_for_each_prefix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rules, "read_move", lambda p, token, read=rules.read_move: seen.append(token) or read(p, token))
    lists, seen = [["e4", "e5"], ["e4", "e5", "Nf3", "Ke9", "d4"], ["e4", "e5", "Nf3", "Ke9", "x"], ["e4", "e5", "Nf3"], [], ["d4"]], []
    assert list(rules.legal_prefixes(lists)) == [["e2e4", "e7e5"], *[["e2e4", "e7e5", "g1f3"]] * 3, [], ["d2d4"]] and seen == ["e4", "e5", "Nf3", "Ke9", "d4"]
    # a book of one line many times: the moves of a game that is there again aren't read again
    total = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<string>")
    def counted(tokens: pd.Series) -> pd.Series:
        total.add(len(tokens))
        return tokens

    monkeypatch.setattr(source, "uci_prefix", counted)
    (tmp_path / "a.pgn").write_text("".join(f'[ECO "A{k}"]\n[Opening "one"]\n\n1. e4 e5 *\n\n' for k in range(50)))
    rows = source.pgn_openings(spark, str(tmp_path)).collect()
    assert sorted(r.eco for r in rows) == sorted(f"A{k}" for k in range(50)) and {tuple(r.moves) for r in rows} == {("e4", "e5")} and total.value == 1
