"""Spelling variants: words at one edit, by two-dimensional range reporting.

A word w and a word of length L that has a free character at position k share
the prefix w[:k] and the last L - 1 - k characters, whether w has L characters
(one replaced) or L - 1 (one inserted); a deletion is an insertion seen from the
other side.  Among the words of length L in forward order those with the prefix
are an interval, and so are those with the suffix in the order of reversed
words.  A wavelet tree over the permutation between both orders reports the
words in both intervals, and only those.

The words of one length are dealt to cells by ranges of forward order, and again
by ranges of reverse order.  For each word and length a split point is chosen:
positions from there on are asked in forward order, where the prefix is long and
meets few cells, those before it in reverse order, where the suffix is long.
The split point is the one that meets the fewest cells, so a prefix that a third
of the words have is answered from the other side.  Bounds of cells come from a
hash sample of the words and only decide who does the work, not what is found.

A pair is reported once: by the shorter word at the last of the positions
where the insertion gives the same, or by each of two words of equal length.

Null texts have no words; a null doc_id counts as the text ''; repeated rows count as rows; words may be of any length; no rows give none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch

#: Words to a cell, on average, until there are MOST_CELLS; then cells grow. Bounds, a sample of at most 32 words a cell, go to every task.
CELL_WORDS, MOST_CELLS = 4_096, 4_096
#: Characters of a bound between cells.
BOUND = 24
#: Words whose partial counts a task holds before it passes them on.
HELD_WORDS = 300_000
#: Rows of positions that a cell asks at once.
ASKED = 1 << 20

_RUNS = re.compile("[A-Za-z\u00C0-\u00FF]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word, n): the runs of letters of whole texts; a run whose crc32 with its doc_id is divisible by ``every`` loses one character."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
                for run, n in Counter(_RUNS.findall((text or b"").translate(_LOWER).decode())).items():
                    h = crc32(f"{name}:{run}".encode())
                    if h % every == 0:
                        k = h % len(run)
                        run = run[:k] + run[k + 1 :]
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield from _rows(held)
                    held.clear()
        yield from _rows(held)

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return named.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _rows(held: Counter[str]) -> Iterator[pa.RecordBatch]:
    words, counts = list(held.keys()), list(held.values())
    for at in range(0, len(words), 50_000):
        yield pa.RecordBatch.from_pydict({"word": pa.array(words[at : at + 50_000], pa.string()), "n": pa.array(counts[at : at + 50_000], pa.int64())})


class WaveletTree:
    """A permutation's values by position, level by level from their highest bit; reports the positions' values in a range."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.levels = []
        for level in reversed(range(self.bits)):
            bit = values >> level & 1
            self.levels.append(np.concatenate(([0], np.cumsum(bit == 0))))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def report(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of all values in [low, high) at positions [left, right), for many queries at once."""
        query, value = np.arange(len(left)), np.zeros(len(left), np.int64)
        keep = (left < right) & (low < high)
        query, value, left, right = query[keep], value[keep], left[keep], right[keep]
        for level, zeros in zip(reversed(range(self.bits)), self.levels, strict=True):
            a, b = zeros[left], zeros[right]
            left = np.concatenate((a, left - a + zeros[-1]))
            right = np.concatenate((b, right - b + zeros[-1]))
            query, value = np.concatenate((query, query)), np.concatenate((value, value + (1 << level)))
            keep = (left < right) & (value < high[query]) & (value + (1 << level) > low[query])
            query, value, left, right = query[keep], value[keep], left[keep], right[keep]
        return query, value


def _letters(words: list[str], length: int) -> np.ndarray:
    """A row for each word, a column for each character; all characters of words are single bytes in Latin-1, in code-point order."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def _order(letters: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel())


def intervals(ordered: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 0, 1, ...: the interval of rows of ``ordered`` (sorted) that share their first k characters with each row of ``asked``."""
    n, length = ordered.shape
    starts, inside = np.zeros(1, np.int64), np.zeros(n, np.int64)
    place = np.zeros(len(asked), np.int64)
    left, right = np.zeros(len(asked), np.int64), np.full(len(asked), n)
    for k in range(length):
        yield left, right
        if k == min(length, asked.shape[1]):
            return
        keys = inside * 256 + ordered[:, k]
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        starts, distinct = np.flatnonzero(first), keys[first]
        inside = np.cumsum(first) - 1
        wanted = place * 256 + asked[:, k]
        place = np.minimum(np.searchsorted(distinct, wanted), len(distinct) - 1)
        there = (distinct[place] == wanted) & (left < right)
        left = np.where(there, starts[place], 0)
        right = np.where(there, np.append(starts, n)[place + 1], 0)


def near_in_cell(words: list[str], asked: list[str], length: int, splits: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``asked``, place in ``words``) of words of ``length`` that are one edit from those asked, all of one length.

    Forward, positions from each asked word's split point on; backward, those before it.
    """
    size = len(asked[0])
    matrix, questions = _letters(words, length), _letters(asked, size)
    ordered = _order(matrix)
    matrix = matrix[ordered]
    turned = _order(matrix[:, ::-1])
    tree = WaveletTree(np.argsort(turned))
    prefixes = intervals(matrix, questions)
    # suffix intervals are asked shortest last, so they are kept: two numbers for each asked word and position
    suffixes = list(intervals(np.ascontiguousarray(matrix[turned][:, ::-1]), np.ascontiguousarray(questions[:, ::-1])))
    found = []
    for k, (left, right) in enumerate(prefixes):
        low, high = suffixes[length - 1 - k]
        there = np.flatnonzero((left < right) & (low < high) & ((k < splits) if backward else (k >= splits)))
        query, value = tree.report(left[there], right[there], low[there], high[there])
        query, target = there[query], turned[value]
        if size == length:
            keep = questions[query, k] != matrix[target, k]
        else:
            keep = np.full(len(query), True) if k == size else questions[query, k] != matrix[target, k]
        found.append((query[keep], ordered[target[keep]]))
    return np.concatenate([q for q, _ in found]), np.concatenate([t for _, t in found])


class Cells:
    """Ranges of words of each length in forward and in reverse order."""

    def __init__(self, sample: list[tuple[int, str, str]], words: int):
        """``sample``: lengths, first and reversed last characters of some words; ``words``: how many there are."""
        cells = max(1, min(MOST_CELLS, -(-words // CELL_WORDS)))
        self.bounds = []
        for side in (1, 2):
            keys = sorted((row[0], row[side]) for row in sample)
            self.bounds.append(sorted(set(keys[:: max(1, -(-len(keys) // cells))][1:])))
        #: Cells of reverse order are numbered from here on.
        self.backward = len(self.bounds[0]) + 1

    def of(self, word: str) -> tuple[int, int]:
        """The cells of a word in both orders."""
        fore, back = (bisect_right(b, (len(word), part)) for b, part in zip(self.bounds, (word[:BOUND], word[: -BOUND - 1 : -1]), strict=True))
        return fore, self.backward + back

    def _meeting(self, side: int, length: int, start: str) -> range:
        """Cells that can hold words of ``length`` which begin with ``start``, in the order's direction."""
        bounds = self.bounds[side]
        return range(bisect_right(bounds, (length, start)), bisect_right(bounds, (length, (start + "\u0100" * BOUND)[:BOUND])) + 1)

    def questions(self, word: str, length: int) -> list[tuple[int, int]]:
        """(cell, split point) to which ``word`` is sent for words of ``length``."""
        best, middle = None, (length + 1) // 2
        for away in range(min(middle, BOUND) + 1):
            for split in (middle + away, middle - away):
                if not 0 <= split <= length:
                    continue
                # forward for positions from the split point on, backward for those before it
                fore = self._meeting(0, length, word[: min(split, BOUND)]) if split < length else range(0)
                back = self._meeting(1, length, word[: -min(length - split, BOUND) - 1 : -1]) if split else range(0)
                if best is None or len(fore) + len(back) < best[0]:
                    best = len(fore) + len(back), split, fore, back
            if best[0] <= 2:
                break
        _, split, fore, back = best
        return [(c, split) for c in fore] + [(self.backward + c, split) for c in back]


def _dealt(cells: Cells):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                out = []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist(), strict=True):
                    out += [(c, len(word), -1, word, n) for c in cells.of(word)]
                    out += [(c, length, split, word, n) for length in (len(word), len(word) + 1) for c, split in cells.questions(word, length)]
                cell, length, split, word, n = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(length, pa.int32()), pa.array(split, pa.int32()), pa.array(word, pa.string()), pa.array(n, pa.int64())], ["cell", "length", "split", "word", "n"])

    return work


def _summed(words: np.ndarray, near: np.ndarray, near_n: np.ndarray) -> pd.DataFrame:
    """For each word how many are near, and of those the one of largest n, the first of equals."""
    rows = pd.DataFrame({"word": words, "form": near, "form_n": near_n}).sort_values(["word", "form_n", "form"], ascending=[True, False, True], kind="stable")
    return rows.groupby("word", sort=False).agg(n_near=("form", "size"), form=("form", "first"), form_n=("form_n", "first")).reset_index()


def near_words(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, n_near, form, form_n): for words that have any, how many of ``counts`` (word, n) are at one edit, and the most frequent of them."""
    words = counts.count()
    share = max(1, words // (16 * MOST_CELLS))  # draws 16 to 32 words a cell
    drawn = counts.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0)
    sample = drawn.select(F.char_length("word"), F.left("word", F.lit(BOUND)), F.reverse(F.right("word", F.lit(BOUND)))).collect()
    cells = Cells([tuple(row) for row in sample], words)

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["split"] < 0
        words, asked = rows[own], rows[~own]
        length, backward = int(rows["length"].iloc[0]), bool(rows["cell"].iloc[0] >= cells.backward)
        found = []
        names, n = words["word"].to_numpy(object), words["n"].to_numpy()
        if len(words):
            for size, some in asked.groupby(asked["word"].str.len()):
                step = max(1, ASKED // length)
                for at in range(0, len(some), step):
                    part = some.iloc[at : at + step]
                    q, t = near_in_cell(names.tolist(), part["word"].tolist(), length, part["split"].to_numpy(), backward)
                    ask, ask_n = part["word"].to_numpy(object)[q], part["n"].to_numpy()[q]
                    found.append(_summed(ask, names[t], n[t]))
                    if size < length:
                        found.append(_summed(names[t], ask, ask_n))
        out = pd.concat(found) if found else pd.DataFrame({"word": [], "n_near": [], "form": [], "form_n": []})
        return out.astype({"word": object, "form": object})

    parts = counts.mapInArrow(_dealt(cells), "cell int, length int, split int, word string, n long").groupBy("cell", "length").applyInPandas(cell, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def variants(docs: DataFrame, scratch: Scratch, every: int = 97, least_length: int = 5, least_n: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word with the more usual spelling next to it, and the one that those lead to."""
    counts = scratch.save(word_counts(docs, every).where((F.char_length("word") >= least_length) & (F.col("n") >= least_n)), "words")
    near = near_words(counts, scratch)
    wins = F.col("form_n") >= ratio * F.col("n")
    rows = counts.join(near, "word", "left").select(
        "word", F.when(wins, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(wins, F.col("form_n")).alias("form_n")
    )
    rows = scratch.save(rows, "forms")
    return rows.join(roots(rows, scratch), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of words with a form: each round doubles how far all words have followed, until all stand on a word without one."""
    step, k = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        after = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.save(step.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        if k:
            scratch.drop(f"roots-{k - 1}")
        if not moved.where("moved").head(1):
            return moved.select("word", "root")
        step, k = moved.select("word", "root"), k + 1
