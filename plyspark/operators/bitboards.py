"""Attacks on boards of 64 bits, in column expressions alone.

A board is a set of masks, one for each piece letter: bit 0 is a1, bit 63 is h8. Pieces of a kind move together: a
slide in one direction is filled over empty squares in three doublings, a leap is a shift; file masks keep either from running over
the edge. Each square that a slide reaches is reached by one piece only in its direction, so moves are counted by bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = "PNBRQKpnbrqk"
#: Bits of the files a..h and ranks 1..8.
FILES = [sum(1 << (8 * r + f) for r in range(8)) for f in range(8)]
RANKS = [0xFF << (8 * r) for r in range(8)]
ROOK = [(0, 1), (0, -1), (1, 0), (-1, 0)]
BISHOP = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
LEAPS = [(a, b) for a in (-2, -1, 1, 2) for b in (-2, -1, 1, 2) if abs(a) != abs(b)]


def _literal(bits: int) -> Column:
    bits &= (1 << 64) - 1
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def _any(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), columns)


def _edge(files: int) -> int:
    """Squares on which a step of so many files (to the right) has arrived within the board."""
    lost = FILES[:files] if files > 0 else FILES[8 + files :] if files < 0 else []
    return ~sum(lost)


def shifted(squares: Column, files: int, ranks: int) -> Column:
    """All ``squares`` moved by so many files and ranks; those over the edge are gone."""
    by = files + 8 * ranks
    moved = F.shiftleft(squares, by) if by > 0 else F.shiftrightunsigned(squares, -by)
    return moved.bitwiseAND(_literal(_edge(files)))


def slid(pieces: Column, empty: Column, files: int, ranks: int) -> Column:
    """Squares that ``pieces`` reach by sliding in one direction: empty ones, and the first that isn't."""
    through = empty.bitwiseAND(_literal(_edge(files)))
    by = files + 8 * ranks
    move = lambda x, n: F.shiftleft(x, by * n) if by > 0 else F.shiftrightunsigned(x, -by * n)
    reach = pieces.bitwiseOR(through.bitwiseAND(move(pieces, 1)))
    twice = through.bitwiseAND(move(through, 1))
    reach = reach.bitwiseOR(twice.bitwiseAND(move(reach, 2)))
    four = twice.bitwiseAND(move(twice, 2))
    reach = reach.bitwiseOR(four.bitwiseAND(move(reach, 4)))
    return shifted(reach, files, ranks)


def mask(board: Column, pieces: str) -> Column:
    """The squares of a board (64 characters, a1 first) that hold one of ``pieces``."""
    ones = "".join("1" if p in pieces else "0" for p in "." + PIECES)
    return F.conv(F.reverse(F.translate(board, "." + PIECES, ones)), 2, -10).cast("long")


def with_attacks(df: DataFrame, board: str) -> DataFrame:
    """``df`` with, for each side, ``_attacks`` (what it attacks, taken or not), ``_men``, and ``_takes``, its captures by bits in each direction.

    NULL where the board is. Kings may be missing or many: each attacks.
    """
    masks = {f"_{'w' if p.isupper() else 'b'}{p.lower()}": mask(F.col(board), p) for p in PIECES}
    df = df.withColumns(masks)
    c = F.col
    men = {s: _any([c(f"_{s}{p}") for p in "pnbrqk"]) for s in "wb"}
    df = df.withColumns({f"_{s}men": m for s, m in men.items()})
    df = df.withColumn("_empty", F.bitwise_not(c("_wmen").bitwiseOR(c("_bmen"))))
    df = df.withColumns({f"_{s}{name}": c(f"_{s}{a}").bitwiseOR(c(f"_{s}q")) for s in "wb" for name, a in (("lines", "r"), ("diagonals", "b"))})
    found = {}
    for s, up in (("w", 1), ("b", -1)):
        for k, (f, r) in enumerate(ROOK + BISHOP):
            found[f"_{s}d{k}"] = slid(c(f"_{s}lines" if k < 4 else f"_{s}diagonals"), c("_empty"), f, r)
            found[f"_{s}k{k}"] = shifted(c(f"_{s}k"), f, r)
        for k, (f, r) in enumerate(LEAPS):
            found[f"_{s}n{k}"] = shifted(c(f"_{s}n"), f, r)
        for k, f in enumerate((-1, 1)):
            found[f"_{s}p{k}"] = shifted(c(f"_{s}p"), f, up)
    df = df.withColumns(found)
    for s, name, foe in (("w", "white", "_bmen"), ("b", "black", "_wmen")):
        own = [n for n in found if n.startswith(f"_{s}")]
        last = _literal(RANKS[7] if s == "w" else RANKS[0])
        takes = lambda n: F.bit_count(c(n).bitwiseAND(c(foe)))  # noqa: E731, B023
        # a pawn that takes on the last rank may become one of four
        promoted = [3 * F.bit_count(c(n).bitwiseAND(c(foe)).bitwiseAND(last)) for n in own if n[2] == "p"]  # noqa: B023
        df = df.withColumns({f"{name}_attacks": _any([c(n) for n in own]), f"{name}_men": c(f"_{s}men"), f"{name}_takes": reduce(lambda a, b: a + b, [*map(takes, own), *promoted])})
    return df.drop(*masks, *found, "_wmen", "_bmen", "_empty", "_wlines", "_blines", "_wdiagonals", "_bdiagonals")


#: Far halves of the board as White and Black see it.
FAR = {"white": sum(RANKS[4:]), "black": sum(RANKS[:4])}


def controlled(side: str) -> Column:
    """How many squares of the other half a side attacks."""
    return F.bit_count(F.col(f"{side}_attacks").bitwiseAND(_literal(FAR[side])))


def hanging() -> Column:
    """Pieces of either side that are attacked and not defended."""
    left = lambda own, foe: F.col(f"{own}_men").bitwiseAND(F.col(f"{foe}_attacks")).bitwiseAND(F.bitwise_not(F.col(f"{own}_attacks")))
    return F.bit_count(left("white", "black").bitwiseOR(left("black", "white")))


def attack_features(df: DataFrame, board: str) -> DataFrame:
    """``df`` with attacked squares, controlled squares and captures of each side (before rules of check, and of pawns in passing), and hanging pieces."""
    rows = with_attacks(df, board)
    columns = {}
    for s in ("white", "black"):
        columns |= {f"{s}_attacked": F.bit_count(f"{s}_attacks"), f"{s}_controlled": controlled(s), f"{s}_captures": F.col(f"{s}_takes").cast("int")}
    names = [f"{s}_{x}" for s in ("white", "black") for x in ("attacks", "men", "takes")]
    return rows.withColumns(columns | {"hanging": hanging()}).drop(*names)
