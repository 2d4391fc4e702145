"""Positions, legal moves and move text. Squares are 0..63, a1 first, h8 last; pieces are FEN letters, '.' none."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
_LINES = {"r": [(0, 1), (1, 0), (0, -1), (-1, 0)], "b": [(1, 1), (1, -1), (-1, 1), (-1, -1)]}
_LINES["q"] = _LINES["k"] = _LINES["r"] + _LINES["b"]
_LINES["n"] = [(a, b) for a in (-2, -1, 1, 2) for b in (-2, -1, 1, 2) if abs(a) != abs(b)]
#: Castling: letter -> (king from, to, rook from, to, squares that must be empty, squares that must be safe).
_CASTLES = {"K": (4, 6, 7, 5, (5, 6), (4, 5, 6)), "Q": (4, 2, 0, 3, (1, 2, 3), (4, 3, 2)), "k": (60, 62, 63, 61, (61, 62), (60, 61, 62)), "q": (60, 58, 56, 59, (57, 58, 59), (60, 59, 58))}


def square(name: str) -> int:
    return "abcdefgh".index(name[0]) + 8 * (int(name[1]) - 1)


def name(sq: int) -> str:
    return "abcdefgh"[sq % 8] + str(sq // 8 + 1)


def _rays(kind: str, sq: int) -> tuple[tuple[int, ...], ...]:
    out = []
    for dr, df in _LINES[kind]:
        line = []
        r, f = sq // 8 + dr, sq % 8 + df
        while 0 <= r < 8 and 0 <= f < 8:
            line.append(8 * r + f)
            if kind in "kn":
                break
            r, f = r + dr, f + df
        if line:
            out.append(tuple(line))
    return tuple(out)


def _pawn_takes(white: bool, sq: int) -> tuple[int, ...]:
    r, f = sq // 8 + (1 if white else -1), sq % 8
    return tuple(8 * r + x for x in (f - 1, f + 1) if 0 <= x < 8 and 0 <= r < 8)


#: By piece and square: the squares in each direction, nearest first (one for kings and knights); and what pawns take.
RAYS = {k: [_rays(k, sq) for sq in range(64)] for k in _LINES}
PAWN_TAKES = {w: [_pawn_takes(w, sq) for sq in range(64)] for w in (True, False)}


class Move(NamedTuple):
    source: int
    to: int
    promotion: str = ""

    @property
    def uci(self) -> str:
        return name(self.source) + name(self.to) + self.promotion


class Position:
    """A position; ``play`` gives the next one."""

    def __init__(self, fen: str = START):
        parts = [*fen.split(), "w", "-", "-", "0", "1"][: max(6, len(fen.split()))]
        rows = parts[0].split("/")
        cells = ["".join("." * int(c) if c.isdigit() else c for c in row) for row in reversed(rows)]
        if len(cells) != 8 or any(len(c) != 8 for c in cells) or set("".join(cells)) - set(".pnbrqkPNBRQK"):
            raise ValueError(f"not a position: {fen}")
        self.cells = list("".join(cells))
        self.white = parts[1] == "w"
        self.castling = parts[2]
        self.passing = square(parts[3]) if parts[3] != "-" else None

    @classmethod
    def of_key(cls, key: str) -> Position:
        """The position of a ``key``."""
        p = object.__new__(cls)
        cells, side, p.castling, passing = key.split()
        p.cells, p.white, p.passing = list(cells), side == "w", square(passing) if passing != "-" else None
        return p

    def key(self) -> str:
        """Text that two positions share only if the same moves follow: a pawn in passing counts where one can take it."""
        taken = self.passing is not None and any(self.cells[s] == ("P" if self.white else "p") for s in PAWN_TAKES[not self.white][self.passing])
        return f"{''.join(self.cells)} {'w' if self.white else 'b'} {self.castling} {name(self.passing) if taken else '-'}"

    def own(self, sq: int, white: bool) -> bool:
        c = self.cells[sq]
        return c != "." and c.isupper() == white

    def attacks(self, sq: int) -> Iterator[int]:
        """Squares that the piece on ``sq`` attacks, taken or not."""
        kind = self.cells[sq].lower()
        if kind == "p":
            yield from PAWN_TAKES[self.cells[sq] == "P"][sq]
        elif kind != ".":
            for line in RAYS[kind][sq]:
                for to in line:
                    yield to
                    if self.cells[to] != ".":
                        break

    def attacked(self, sq: int, white: bool) -> bool:
        """Whether a piece of White (or Black) attacks ``sq``, looked for from the square itself."""
        up = str.upper if white else str.lower
        for kind, takers in (("n", "n"), ("k", "k"), ("r", "rq"), ("b", "bq")):
            wanted = {up(c) for c in takers}
            for line in RAYS[kind][sq]:
                for to in line:
                    if self.cells[to] != ".":
                        if self.cells[to] in wanted:
                            return True
                        break
        return any(self.cells[s] == up("p") for s in PAWN_TAKES[not white][sq])

    def king(self, white: bool) -> int | None:
        k = "K" if white else "k"
        return self.cells.index(k) if k in self.cells else None

    def in_check(self, white: bool) -> bool:
        k = self.king(white)
        return k is not None and self.attacked(k, not white)

    def _candidates(self) -> Iterator[Move]:
        w, ahead = self.white, 8 if self.white else -8
        for sq, c in enumerate(self.cells):
            if c == "." or c.isupper() != w:
                continue
            if c in "pP":
                targets = [to for to in PAWN_TAKES[w][sq] if self.own(to, not w) or to == self.passing]
                if self.cells[sq + ahead] == ".":
                    targets.append(sq + ahead)
                    if sq // 8 == (1 if w else 6) and self.cells[sq + 2 * ahead] == ".":
                        targets.append(sq + 2 * ahead)
                for to in targets:
                    yield from (Move(sq, to, p) for p in ("qrbn" if to // 8 in (0, 7) else ("",)))
            else:
                yield from (Move(sq, to) for to in self.attacks(sq) if not self.own(to, w))
        for letter, (king, to, rook, _, empty, safe) in _CASTLES.items():
            k, r = ("K", "R") if w else ("k", "r")
            if letter in self.castling and letter.isupper() == w and self.cells[king] == k and self.cells[rook] == r:
                if all(self.cells[s] == "." for s in empty) and not any(self.attacked(s, not w) for s in safe):
                    yield Move(king, to)

    def legal_moves(self) -> list[Move]:
        return [m for m in self._candidates() if not self.play(m).in_check(self.white)]

    def is_capture(self, m: Move) -> bool:
        return self.cells[m.to] != "." or (self.cells[m.source] in "pP" and m.to == self.passing)

    def passed_turn(self) -> Position:
        """The same with the other side to move and no pawn to take in passing."""
        p = object.__new__(Position)
        p.cells, p.white, p.castling, p.passing = list(self.cells), not self.white, self.castling, None
        return p

    def play(self, m: Move) -> Position:
        p = self.passed_turn()
        c, w = self.cells[m.source], self.white
        p.cells[m.source] = "."
        p.cells[m.to] = (m.promotion.upper() if w else m.promotion) or c
        if c in "pP":
            if m.to == self.passing:
                p.cells[m.to + (-8 if w else 8)] = "."
            if abs(m.to - m.source) == 16:
                p.passing = (m.to + m.source) // 2
        gone = ""
        for letter, (king, to, rook, rook_to, _, _) in _CASTLES.items():
            if c in "kK" and m.source == king and m.to == to and letter in self.castling:
                p.cells[rook], p.cells[rook_to] = ".", "R" if w else "r"
            if king in (m.source, m.to) or rook in (m.source, m.to):
                gone += letter
        p.castling = "".join(x for x in self.castling if x not in gone) or "-"
        return p


def read_move(p: Position, text: str) -> Move | None:
    """The legal move that ``text`` names, as e2e4, e7e8q, Nf3, exd5, R1e2, O-O or e8=Q; None if none or more than one does."""
    legal = p.legal_moves()
    by_uci = {m.uci: m for m in legal}
    if text in by_uci:
        return by_uci[text]
    san = text.rstrip("+#!?").replace("0", "O")
    if san in ("O-O", "O-O-O"):
        to = (6 if san == "O-O" else 2) + (0 if p.white else 56)
        found = [m for m in legal if p.cells[m.source] in "kK" and m.to == to and abs(m.to - m.source) == 2]
    else:
        san = text.rstrip("+#!?").replace("x", "").replace("-", "").replace("=", "")
        promotion = san[-1].lower() if san[-1:] in ("Q", "R", "B", "N") and len(san) > 2 else ""
        san = san[:-1] if promotion else san
        kind = san[0] if san[:1] in tuple("NBRQK") else "P"
        body = san[1:] if kind != "P" else san
        if len(body) < 2 or body[-2] not in "abcdefgh" or body[-1] not in "12345678":
            return None
        to, hint = square(body[-2:]), body[:-2]
        found = [m for m in legal if m.to == to and p.cells[m.source].upper() == kind and m.promotion == promotion and all(h in name(m.source) for h in hint)]
    return found[0] if len(found) == 1 else None


def legal_prefixes(lists: Iterable[list[str]]) -> Iterator[list[str]]:
    """UCI text of each list's moves up to the first that isn't legal, from the start of a game.

    Moves that a list has in common with the one before aren't read again, so sorted lists cost one reading for each distinct prefix.
    """
    start, line = Position(), []  # token, UCI text and position after it; both None for one that isn't legal
    for tokens in lists:
        n = next((k for k, (x, y) in enumerate(zip(line, tokens)) if x[0] != y), min(len(line), len(tokens)))
        del line[n:]
        p = line[-1][2] if line else start
        for token in tokens[n:] if p else ():
            m = read_move(p, token)
            p = p.play(m) if m else None
            line.append((token, m.uci if m else None, p))
            if m is None:
                break
        yield [uci for _, uci, _ in line if uci]


def legal_prefix(tokens: list[str]) -> list[str]:
    """UCI text of the moves up to the first that isn't legal, from the start of a game."""
    return next(legal_prefixes([tokens]))


def perft(p: Position, depth: int) -> int:
    """Sequences of ``depth`` legal moves."""
    if depth == 0:
        return 1
    moves = p.legal_moves()
    return len(moves) if depth == 1 else sum(perft(p.play(m), depth - 1) for m in moves)
