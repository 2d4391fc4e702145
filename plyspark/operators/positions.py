"""Features of positions from FEN text.

What needs no rules of check is column expressions, over the 64 cells of the board or, for attacks, over its masks of 64 bits
(``bitboards``); legal moves come from one pandas UDF, which runs once for each distinct FEN.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..chesscore.rules import Position, legal_prefixes, perft, read_move
from . import bitboards

#: What pieces are worth to the classifier, to the balance, and to the game's phase.
CENTIPAWNS = {"p": 100, "n": 320, "b": 330, "r": 500, "q": 900}
POINTS = {"p": 1, "n": 3, "b": 3, "r": 5, "q": 9, "k": 10000}
PHASE, PHASE_START = {"n": 1, "b": 1, "r": 2, "q": 4}, 24


def cells(fen: Column) -> Column:
    """The board as 64 characters, a1 first and h8 last, '.' where none; NULL where that isn't what the FEN holds."""
    board = F.split(F.trim(fen), r"\s+")[0]
    for n in range(1, 9):
        board = F.replace(board, F.lit(str(n)), F.lit("." * n))
    flat = F.array_join(F.reverse(F.split(board, "/")), "")
    return F.when(flat.rlike("^[.pnbrqkPNBRQK]{64}$"), flat)


def fen_part(fen: Column, n: int, default: str) -> Column:
    return F.coalesce(F.get(F.split(F.trim(fen), r"\s+"), F.lit(n)), F.lit(default))


def number_of(board: Column, pieces: str) -> Column:
    return F.regexp_count(board, F.lit(f"[{pieces}]"))


def weighed(board: Column, worth: dict[str, int], white: bool) -> Column:
    return reduce(lambda a, b: a + b, [number_of(board, k.upper() if white else k) * v for k, v in worth.items()])


def game_phase(fen: Column) -> Column:
    """opening, midgame or endgame by the material that is gone and the half moves played."""
    board = cells(fen)
    both = lambda k: number_of(board, k + k.upper())
    gone = PHASE_START - reduce(lambda a, b: a + b, [both(k) * v for k, v in PHASE.items()])
    ply = fen_part(fen, 5, "1").try_cast("int") * 2 - F.when(fen_part(fen, 1, "w") == "w", 0).otherwise(1)
    return F.when((gone < 0.25 * PHASE_START) & (ply <= 30), "opening").when(gone < 2 / 3 * PHASE_START, "midgame").when(board.isNotNull(), "endgame")


def balance(fen: Column) -> Column:
    return weighed(cells(fen), POINTS, True) - weighed(cells(fen), POINTS, False)


def _sides(board: str) -> dict[str, str]:
    """SQL of pawn and king features over the column ``board``, for each side."""
    out = {}
    at = lambda sq: f"substring({board}, {sq} + 1, 1)"
    for side, pawn, foe, king, men in (("white", "P", "p", "K", "[pnbrqk]"), ("black", "p", "P", "k", "[PNBRQK]")):
        squares = f"filter(sequence(0, 63), s -> {at('s')} = '{pawn}')"
        files = f"transform(sequence(0, 7), f -> size(filter(sequence(0, 7), r -> {at('(r * 8 + f)')} = '{pawn}')))"
        out[f"{side}_files"] = files
        ahead = "t div 8 > s div 8" if side == "white" else "t div 8 < s div 8"
        out[f"{side}_passed"] = f"size(filter({squares}, s -> NOT exists(sequence(0, 63), t -> {at('t')} = '{foe}' AND {ahead} AND abs(t % 8 - s % 8) <= 1)))"
        out[f"{side}_pawns"] = f"size({squares})"
        k = f"(instr({board}, '{king}') - 1)"
        out[f"{side}_king"] = k
        near = f"sequence(greatest({k} % 8 - 1, 0), least({k} % 8 + 1, 7))"
        row = f"({k} div 8 {'+' if side == 'white' else '-'} 1)"
        out[f"{side}_shield_pawns"] = f"CASE WHEN {row} BETWEEN 0 AND 7 THEN size(filter({near}, f -> {at(f'({row} * 8 + f)')} = '{pawn}')) ELSE 0 END"
        out[f"{side}_open_files"] = f"size(filter({near}, f -> NOT exists(sequence(0, 7), r -> {at('(r * 8 + f)')} <> '.')))"
        value = "CASE lower(p) " + " ".join(f"WHEN '{p}' THEN {v}" for p, v in POINTS.items()) + " END"
        distance = f"greatest(abs(s div 8 - {k} div 8) + abs(s % 8 - {k} % 8), 1)"
        out[f"{side}_tropism"] = f"aggregate(sequence(0, 63), 0D, (a, s) -> a + CASE WHEN {at('s')} RLIKE '{men}' THEN cast({value.replace('lower(p)', f'lower({at("s")})')} AS double) / {distance} ELSE 0D END)"
    return out


_MOBILITY = {"num_moves": T.IntegerType(), "capture_ratio": T.DoubleType(), "check_ratio": T.DoubleType(), "legal_enemy": T.IntegerType()}
RULED = T.StructType([T.StructField(n, T.IntegerType()) for n in ("captures", "checks")] + [T.StructField(f"{s}_{n}", t) for s in ("white", "black") for n, t in _MOBILITY.items()])


def _ruled(fen: str | None) -> dict | None:
    try:
        p = Position(fen or "")
    except (ValueError, IndexError):
        return None
    legal = p.legal_moves()
    checks = lambda pos, moves: sum(pos.play(m).in_check(not pos.white) for m in moves)
    out = {"captures": sum(map(p.is_capture, legal)), "checks": checks(p, legal)}
    turned = p
    for side, white in (("white", True), ("black", False)):
        turned = turned if turned.white == white else turned.passed_turn()
        moves = turned.legal_moves()
        far = lambda s: (s >= 32) == white  # noqa: E731, B023
        n = max(len(moves), 1)
        numbers = len(moves), sum(map(turned.is_capture, moves)) / n, checks(turned, moves) / n, sum(far(m.to) for m in moves)
        out |= {f"{side}_{c}": v for c, v in zip(_MOBILITY, numbers, strict=True)}
    return out


@F.pandas_udf(RULED)
def ruled(fens: pd.Series) -> pd.DataFrame:
    rows = pd.DataFrame([_ruled(f) or dict.fromkeys(RULED.names) for f in fens], columns=RULED.names)
    return rows.astype({f.name: "float64" if f.dataType == T.DoubleType() else "Int32" for f in RULED})


def position_features(positions: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """All features of positions (search_id, game_id, fen) that ``done`` has none of yet.

    Each distinct FEN is worked out once. Where a FEN can't be read the label is Unknown and the rest NULL; a NULL FEN is left out.
    """
    rows = positions.where("fen IS NOT NULL")
    if done is not None:
        rows = rows.join(done.select("search_id"), "search_id", "left_anti")
    f = rows.select("fen").distinct().withColumn("board", cells(F.col("fen")))
    f = bitboards.attack_features(f, "board").withColumn("x", ruled("fen"))
    f = f.withColumns({k: F.expr(f"CASE WHEN board IS NOT NULL THEN {v} END") for k, v in _sides("board").items()})
    c = F.col
    doubled = {s: F.expr(f"aggregate({s}_files, 0, (a, n) -> a + greatest(n - 1, 0))") for s in ("white", "black")}
    damage = reduce(lambda a, b: a + b, [F.expr(f"size(filter({s}_files, n -> n > 1)) + size(filter(sequence(0, 7), f -> {s}_files[f] > 0 AND NOT (f > 0 AND {s}_files[greatest(f - 1, 0)] > 0) AND NOT (f < 7 AND {s}_files[least(f + 1, 7)] > 0)))") for s in ("white", "black")])
    board = c("board")
    men = {k: v for k, v in CENTIPAWNS.items() if k != "p"}
    endgame = F.greatest(F.lit(0.0), 1.0 - (weighed(board, men, True) + weighed(board, men, False)) / 3000)
    share = lambda n, most, weight: F.least(n / most, F.lit(1.0)) * weight
    rights = fen_part(c("fen"), 2, "-")
    lost = reduce(lambda a, b: a + b, [F.when(F.contains(rights, F.lit(x)), 0).otherwise(1) for x in "KQkq"])
    tactical = share(c("x.captures"), 6.0, 0.4) + share(c("x.checks"), 2.0, 0.25) + share(c("hanging"), 4.0, 0.25) + F.when(fen_part(c("fen"), 3, "-") != "-", 0.15).otherwise(0.0) + lost / 4 * 0.1 + share(damage, 8, 0.1)
    tactical = F.least(tactical, F.lit(1.0)) * (1.0 - endgame * 0.4)
    imbalance = F.abs(weighed(board, CENTIPAWNS, True) - weighed(board, CENTIPAWNS, False))
    positional = (share(number_of(board, "nbrqNBRQ"), 10, 0.4) + (1 - F.least(imbalance / 900.0, F.lit(1.0))) * 0.35 + (1 - F.least(damage / 8, F.lit(1.0))) * 0.25) * (1.0 - endgame * 0.6)
    f = f.withColumns({"t": tactical, "p": positional, "e": endgame})
    most = F.greatest("t", "p", "e")
    label = F.when(board.isNull(), "Unknown").when(c("t") == most, "Tactical").when(c("p") == most, "Positional").otherwise("Endgame")
    columns = {
        "game_phase": game_phase(c("fen")), "position_type": label, "pos_tactical": F.round("t", 3).cast("float"), "pos_positional": F.round("p", 3).cast("float"), "pos_endgame": F.round("e", 3).cast("float"), "balance": balance(c("fen")),
    }
    for s in ("white", "black"):
        columns |= {f"{s}_backwards": c(f"{s}_pawns") - c(f"{s}_passed") - doubled[s], f"{s}_doubled": doubled[s], f"{s}_passed": c(f"{s}_passed")}
    for s in ("white", "black"):
        columns |= {f"{s}_shield_pawns": c(f"{s}_shield_pawns"), f"{s}_open_files": c(f"{s}_open_files"), f"{s}_tropism": c(f"{s}_tropism").cast("float")}
    for s in ("white", "black"):
        columns |= {f"{s}_{m}": c(f"x.{s}_{m}").cast("float" if t == T.DoubleType() else "int") for m, t in _MOBILITY.items()}
        columns[f"{s}_controlled_enemy"] = c(f"{s}_controlled")
    features = f.select("fen", *[v.alias(k) for k, v in columns.items()])
    return rows.select("search_id", "game_id", "fen").join(features, "fen").select("search_id", "game_id", "fen", *columns)


@F.pandas_udf(T.ArrayType(T.StringType()))
def uci_prefix(tokens: pd.Series) -> pd.Series:
    """Move tokens in either notation to UCI, up to the first that isn't legal. Of sorted lists, what one begins with like the one before is read once."""
    return pd.Series(list(legal_prefixes([] if t is None else list(t) for t in tokens)), index=tokens.index)


@F.pandas_udf(T.ArrayType(T.StringType()))
def moves_in(fens: pd.Series, moves: pd.Series) -> pd.Series:
    """UCI text of moves given as SAN, UCI or a square that some legal move goes to; what names none is left out."""

    def one(fen: str, texts: list[str]) -> list[str]:
        p, out = Position(fen), []
        for text in texts if texts is not None else []:
            clean = text.strip().rstrip(",;").rstrip("+#!?")
            m = read_move(p, clean)
            if m is None and len(clean) == 2:
                m = next((x for x in p.legal_moves() if x.uci[2:4] == clean), None)
            out += [m.uci] if m else []
        return out

    return pd.Series([one(f, m) for f, m in zip(fens, moves, strict=True)])


@F.pandas_udf(T.LongType())
def perft_nodes(fens: pd.Series, depths: pd.Series) -> pd.Series:
    return pd.Series([perft(Position(f), int(d)) for f, d in zip(fens, depths, strict=True)])


def with_truth(searches: DataFrame, truth: DataFrame) -> DataFrame:
    """Evaluations of a reference engine by FEN (fen, sf_eval, sf_best_move, sf_pv), for searches that have none."""
    t = truth.select(F.col("fen").alias("_f"), *[F.col(c).alias(f"_{c}") for c in ("sf_eval", "sf_best_move", "sf_pv")])
    joined = searches.join(t, (F.col("fen") == F.col("_f")) & F.col("sf_eval").isNull(), "left")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in ("sf_eval", "sf_best_move", "sf_pv")}).drop("_f", "_sf_eval", "_sf_best_move", "_sf_pv")


def white_centipawns(kind: Column, value: Column, white: Column, mate: int = 100_000) -> Column:
    """A score for the side to move as White's; a mate counts as ``mate``, its sign by who mates."""
    own = F.when(kind == "mate", F.when(value >= 0, mate).otherwise(-mate)).otherwise(value)
    return F.when(white, own).otherwise(-own)
