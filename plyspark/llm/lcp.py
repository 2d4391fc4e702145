"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases by deterministic coin tossing: runs of an equal
symbol collapse, each symbol gets a small label from the lowest bit in which it
differs from its left neighbour, labels shrink to 0..5 in a few rounds, and
local maxima begin phrases.  A phrase's name is a hash of its symbols;
names are the symbols of the next level.  Cuts depend on a few neighbours only,
so equal substrings have equal interior names at any offset.  A fingerprint
keeps, for each of ``SLOTS`` classes of names, 12 bits of the least name; the likeness of
two is the share of equal slots, an estimate of the Jaccard likeness of the names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import STEP_BYTES, mix, powers, steps, utf8

SLOTS = 128
LEVELS = 3  # phrases of about 25 bytes
_LOWEST = np.array([8] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0..5, unequal for neighbours, each from five symbols to its left at most."""
    if symbols.dtype != np.uint8:
        before = np.empty_like(symbols)
        before[1:] = symbols[:-1]
        before[first] = ~symbols[first]
        d = symbols ^ before
        low = np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1)).astype(np.uint8)
        symbols = (2 * low + ((symbols >> low) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
        rounds = 3
    else:
        rounds = 4
    for _ in range(rounds):
        before = np.empty_like(symbols)
        before[1:] = symbols[:-1]
        before[first] = ~symbols[first]
        low = _LOWEST[symbols ^ before]
        symbols = 2 * low + ((symbols >> low) & 1)
    return symbols


def _level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of a sequence of symbols, and which begin a text; ``first`` says so of the symbols."""
    begins = first.copy()
    begins[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(begins)
    run = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    symbols, first = symbols[at], first[at]
    label = _labels(symbols, np.flatnonzero(first)).astype(np.int8)
    left, right = np.empty_like(label), np.empty_like(label)
    left[1:], right[:-1] = label[:-1], label[1:]
    right[-1] = -1
    starts = np.flatnonzero(first)
    left[starts] = -1
    right[starts[1:] - 1] = -1
    begins = first | ((label > left) & (label > right))
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(label)))
    within = np.arange(len(label)) - np.repeat(at, length)
    value = mix(symbols.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + run)
    names = mix(np.add.reduceat(value * powers(int(length.max()))[within], at) + length.astype(np.uint64))
    return names, first[at]


def sketches(data: np.ndarray, offsets: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Texts x SLOTS numbers of 12 bits, 0 where no name falls in the slot."""
    docs = len(offsets) - 1
    out = np.full(docs * SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    full = np.flatnonzero(offsets[:-1] < offsets[1:])
    if len(full):
        first = np.zeros(len(data), bool)
        first[offsets[:-1][full]] = True
        symbols = data
        for _ in range(levels):
            symbols, first = _level(symbols, first)
        of = full[np.cumsum(first) - 1]
        np.minimum.at(out, of * SLOTS + (symbols >> np.uint64(57)).astype(np.int64), symbols & np.uint64((1 << 57) - 1))
    found = (out % np.uint64(4095) + np.uint64(1)).astype(np.uint16)
    found[out == np.uint64(0xFFFFFFFFFFFFFFFF)] = 0
    return found.reshape(docs, SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of sketches row by row; 1 where both are empty."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def as_text(found: np.ndarray) -> list[str]:
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    laid = np.stack([digits[found >> 8], digits[(found >> 4) & 15], digits[found & 15]], axis=2).reshape(len(found), -1)
    return [row.tobytes().decode() for row in laid]


def fingerprints(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, fingerprint): three hexadecimal digits for each slot, a row for each row of ``docs`` (doc_id, text).

    A null text is as an empty one, whose fingerprint is all zeros; a text shorter than a phrase is one phrase.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                found = as_text(sketches(*utf8(part.column("text")), levels))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


_LEAST = -(1 << 63)


def _range_of(bounds: np.ndarray, o: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The last of ``bounds``, rows (o, h) in order, that isn't after each row."""
    low, high = np.searchsorted(bounds[:, 0], o, "left"), np.searchsorted(bounds[:, 0], o, "right")
    found = high - 1
    for k in np.flatnonzero(high > low):  # a bound has the same id
        found[k] = low[k] + np.searchsorted(bounds[low[k] : high[k], 1], h[k], "right") - 1
    return found


def with_next(docs: DataFrame, rows_of_range: int = 8192) -> DataFrame:
    """``docs`` (doc_id, text) laid out by ascending doc_id in ranges, one to a partition: (r, look, o, h, doc_id, text).

    Range r's rows with look 0 are its own; its first row with look 1, if sorted by o and h, is the row after
    the last of them, from the next range or, after the last range, from the first.  Nulls come first; rows
    of equal doc_id are ordered by the text's hash.  The ranges' least ids, 16 bytes for each ``rows_of_range`` rows, come to the driver and go to the tasks.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("o")
    ordered = docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ids = ordered.select("o", "h")
    ranges = max(1, -(-ids.count() // rows_of_range))
    least = ids.repartitionByRange(ranges, "o", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("o", "h")).alias("x")).select("x.*").collect()
    bounds = np.array(sorted({(x["o"], x["h"]) for x in least}), np.int64).reshape(-1, 2)
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = shared.value
        for batch in batches:
            o, h = batch.column("o").to_numpy(), batch.column("h").to_numpy()
            r = np.maximum(_range_of(bounds, o, h), 0)
            copies = np.flatnonzero((bounds[r, 0] == o) & (bounds[r, 1] == h))
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(np.zeros(len(o), np.int8)), *batch.columns], names=["r", "look", *batch.schema.names])
            if len(copies):
                part = batch.take(pa.array(copies))
                yield pa.RecordBatch.from_arrays([pa.array((r[copies] - 1) % len(bounds)), pa.array(np.ones(len(copies), np.int8)), *part.columns], names=["r", "look", *batch.schema.names])

    dealt = ordered.select("o", "h", "doc_id", "text").mapInArrow(deal, "r long, look byte, o long, h long, doc_id long, text string")
    return dealt.repartitionById(max(1, len(bounds)), F.col("r").cast("int")).sortWithinPartitions("r", "look", "o", "h")


def neighbours(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Each document's fingerprint, that of an edited text, and their likeness and that to the next document.

    The edited text has the last quarter (rounded down) of the code points replaced by as many of the next
    document's first, or all it has; next is by ascending doc_id (null first, equal ids by the text's hash), and
    the first after the last.  A null text is empty; every row comes back; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        own: list[bool] = []
        size = 0

        def told() -> pa.RecordBatch:
            """Of all rows but the last, which only follows."""
            raw = [t.encode() for t in texts]
            whole = sketches(*_laid(raw), levels)
            rows = [i for i in range(len(texts) - 1) if own[i]]
            edited = []
            for i in rows:
                cut = len(texts[i]) // 4
                edited.append((texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut]).encode())
            other = sketches(*_laid(edited), levels)
            mine = whole[rows]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in rows], pa.int64()), pa.array([len(texts[i]) for i in rows], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()), pa.array(as_text(mine), pa.string()), pa.array(as_text(other), pa.string()),
                    pa.array(likeness(mine, other)), pa.array(likeness(mine, whole[[i + 1 for i in rows]])),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            for look, doc_id, text in zip(batch.column("look").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if look and own and not own[-1]:
                    continue  # only the first that follows a range counts
                ids.append(doc_id)
                texts.append(text.as_py())
                own.append(not look)
                size += len(texts[-1])
                if size > STEP_BYTES // 2 and len(texts) > 1:
                    yield told()
                    ids, texts, own, size = ids[-1:], texts[-1:], own[-1:], len(texts[-1])
        if len(texts) > 1:
            yield told()

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).select("look", "doc_id", "text").mapInArrow(run, schema)


def _laid(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
