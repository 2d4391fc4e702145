"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

One scan of the documents finds every n-gram of the test items and cuts the passages
around them.  A passage meets an item with which it shares an n-gram of five words, or two different ones of three, so
copies with every fifth word changed meet their item too; no n-gram is left out.  A local alignment of words scores
each pair that has words enough in common to reach the least score.  Words are runs of letters
and digits in lower case; of scripts that write no spaces each character is one.  Items are taken in blocks of bounded
size, each against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, free
from .text import alphanumeric, fold, span_hashes, steps, utf8, words

NGRAM = 5
#: Words of the n-grams of which two are needed.
SHORT = 3
#: Characters that are words of their own.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
#: All of those characters lie in this range, which is looked for first.
BEYOND = r"[\x{0e00}-\x{10ffff}]"
MATCH, OTHER, GAP = 2, -1, -1
#: n-grams of a block of items, at most; they go to every task.
BLOCK_GRAMS = 1_000_000


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    begin, end, of = words(data, offsets, alphanumeric())
    return span_hashes(data, begin, end), begin, end, of, data


def _grams(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row of one text, and the word at which each begins."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(hashes) - n + 1
    h = hashes[:last] + np.uint64(n)
    for k in range(1, n):
        h = fold(h, hashes[k : last + k])
    at = np.flatnonzero(of[:last] == of[n - 1 :])
    return h[at], at


def _plain(text: str) -> Column:
    """The text in lower case, with spaces around characters that are words."""
    low = F.lower(text)
    return F.when(low.rlike(BEYOND), F.regexp_replace(low, UNSPACED, " $1 ")).otherwise(low)


def item_grams(items: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(item, place, n, gram, words, weak): all n-grams of each item, and weak ones of ``SHORT`` words; an item of fewer words has one of its length, one without words none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            hashes, _, _, of, _ = _word_hashes(batch.column("text"))
            for i, item in enumerate(ids):
                own = hashes[of == i]
                for n in sorted({min(ngram, len(own)), min(SHORT, len(own))} - {0}):
                    h, at = _grams(own, np.zeros(len(own), np.int64), n)
                    k = len(h)
                    yield pa.RecordBatch.from_arrays([pa.array([item] * k, pa.int64()), pa.array(at.astype(np.int32)), pa.array(np.full(k, n, np.int32)), pa.array(h.view(np.int64)), pa.array(np.full(k, len(own), np.int32)), pa.array(np.full(k, n < min(ngram, len(own))))], names=["item", "place", "n", "gram", "words", "weak"])

    return items.select("item", _plain("text").alias("text")).mapInArrow(run, "item long, place int, n int, gram long, words int, weak boolean")


def passages(docs: DataFrame, grams: dict[tuple[int, bool], np.ndarray], pad: int) -> DataFrame:
    """(doc_id, first, passage, grams): stretches of documents around n-grams that ``grams`` holds by n and whether they are weak, sorted.

    ``passage`` is the words from ``pad`` before a hit to ``pad`` after, space-joined; hits whose stretches meet share one; ``first`` is the
    number of its first word in the document; ``grams`` are the hits. A weak hit with no other within ``pad`` words is none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for kind, values in shared.value.items():
            sieve = np.zeros(1 << 22, bool)
            sieve[(values >> np.uint64(42)).astype(np.int64)] = True
            held[kind] = values, sieve
        for batch in batches:
            for part in steps(batch):
                ids = part.column("doc_id").to_pylist()
                hashes, begin, end, of, data = _word_hashes(part.column("text"))
                found_at, found, weaker = [], [], []
                for (n, weak), (values, sieve) in held.items():
                    h, at = _grams(hashes, of, n)
                    use = np.flatnonzero(sieve[(h >> np.uint64(42)).astype(np.int64)])
                    use = use[values[np.minimum(np.searchsorted(values, h[use]), len(values) - 1)] == h[use]]
                    found_at.append(at[use])
                    found.append(h[use])
                    weaker.append(np.full(len(use), weak))
                at, gram, weak = np.concatenate(found_at), np.concatenate(found), np.concatenate(weaker)
                order = np.argsort(at, kind="stable")
                at, gram, weak = at[order], gram[order], weak[order]
                close = (np.diff(at) <= pad) & (np.diff(of[at]) == 0)
                use = ~weak
                use[1:] |= close
                use[:-1] |= close
                at, gram = at[use], gram[use]
                cuts = np.flatnonzero((np.diff(at) > 2 * pad) | (np.diff(of[at]) > 0)) + 1
                rows: list[tuple] = []
                base = np.searchsorted(of, np.arange(len(ids)))
                limit = np.searchsorted(of, np.arange(len(ids)), "right")
                for hits, own in zip(np.split(at, cuts), np.split(gram, cuts), strict=True):
                    if not len(hits):
                        continue
                    doc = of[hits[0]]
                    lo, hi = max(base[doc], hits[0] - pad), min(limit[doc], hits[-1] + NGRAM + pad)
                    text = b" ".join(data[b:e].tobytes() for b, e in zip(begin[lo:hi], end[lo:hi], strict=True))
                    rows.append((ids[doc], int(lo - base[doc]), text.decode(), np.unique(own).view(np.int64).tolist()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                        names=["doc_id", "first", "passage", "grams"],
                    )

    lowered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _plain("text").alias("text"))
    return lowered.mapInArrow(run, "doc_id long, first int, passage string, grams array<long>")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences, and the passage's words from and to (exclusive) of it."""
    n = len(passage)
    slope = GAP * np.arange(n + 1)
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, OTHER)
        diagonal, up = row[:-1] + step, row[1:] + GAP
        now, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
        take = (diagonal >= up) & (diagonal > 0)
        now[1:] = np.where(take, diagonal, np.maximum(up, 0))
        origin[1:] = np.where(take, start[:-1], np.where(up > 0, start[1:], origin[1:]))
        # gaps along the passage: the running maximum of score less the slope
        lifted = now - slope
        most = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == most, np.arange(n + 1), 0))
        along = most + slope
        better = along > now
        row, start = np.where(better, along, now), np.where(better, origin[source], origin)
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(start[j]), j)
    return best


def _aligned(least_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                ids: dict[str, int] = {}
                item = np.array([ids.setdefault(w, len(ids)) for w in r["item_words"].split()], np.int64)
                passage = np.array([ids.get(w, -1) for w in r["passage"].split(" ")], np.int64)
                # no alignment scores more than all of the item's words that the passage has
                if np.isin(item, passage).sum() < least_score * len(item):
                    continue
                score, begin, end = align(item, passage)
                out.append((r["doc_id"], r["item"], score / (MATCH * len(item)), r["first"] + begin, r["first"] + end))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item", "score", "first_word", "end_word"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, ngram: int = NGRAM, least_score: float = 0.5, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): documents that hold a test item, in whole or edited.

    ``score`` is the alignment's score over that of the whole item; the best place of each pair
    counts, the first of equals. A null or wordless text, of a document or an item, matches nothing; repeated rows
    give one; a null doc_id is a document like others, a null item_id an item like others; items of one id and unlike texts are items
    of their own, a row each; no rows on either side give none; further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "decontam")
    # an item is its id and text
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text", F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item")).dropDuplicates(["item"])
    grams = scratch.save(item_grams(items, ngram), "grams")
    n, longest = grams.agg(F.count("*"), F.max("words")).first()
    blocks = -(-n // BLOCK_GRAMS)
    clean = F.regexp_replace(_plain("text"), r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ")
    texts = items.select("item", F.trim(clean).alias("item_words")).where("item_words <> ''")
    found = None
    for b in range(blocks):
        own = grams.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        held = {k: np.unique(x["gram"].to_numpy(np.int64).view(np.uint64)) for k, x in own.select("n", "weak", "gram").distinct().toPandas().groupby(["n", "weak"])}
        if not held:
            continue
        cut = scratch.save(passages(docs, held, int(longest)).withColumn("key", F.xxhash64("doc_id", "first", "passage")), f"passages-{b}")
        hits = cut.select("key", F.explode("grams").alias("gram")).distinct()
        met = hits.join(own.select("item", "gram", "weak").distinct(), "gram").groupBy("key", "item").agg(F.count("*").alias("n"), F.min("weak").alias("weak"))
        pairs = met.where("n > 1 OR NOT weak").select("key", "item")
        cases = cut.select("key", "doc_id", "first", "passage").distinct().join(pairs, "key").join(texts, "item")
        part = cases.select("doc_id", "first", "passage", "item", "item_words").mapInArrow(_aligned(least_score), "doc_id long, item long, score double, first_word int, end_word int")
        part = scratch.save(part.where(F.col("score") >= least_score), f"found-{b}")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, first_word int, end_word int")
    best = F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("first_word"), -F.col("end_word"))).alias("best")
    best_of = found.groupBy("doc_id", "item").agg(best)
    return best_of.join(items.select("item", "item_id"), "item").select("doc_id", "item_id", "best.*")


def remove(docs: DataFrame, items: DataFrame, **settings: float) -> DataFrame:
    """``docs`` without the documents that hold an item.

    Rows that repeat stay or go together; rows with a null doc_id go where any such row holds one; nulls and empty texts of documents or
    items match nothing, so such documents stay; further columns stay as they are; no rows give no rows.
    """
    name = free("bad", docs)
    bad = contaminated(docs, items, **settings).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_anti")
