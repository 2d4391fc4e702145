"""Ranked lexical search over a two-level quantised index.

The index holds documents in blocks.  For each block and term one row lists
the documents with the term: level one is their impact in a byte, rounded up,
level two the exact number of occurrences.  The row of the empty term lists the
block's documents themselves, with their ids and sizes.

A search reads level one alone for bounds: with an impact of byte q between
(q - 1) x STEP and q x STEP, sums of weighted bytes bound every document's score
from both sides.  The k-th largest lower bound over all documents is the least
score that can matter; every document whose upper bound reaches it, ties and
copies included, is scored again in integers from level two.  Blocks are
scored where they lie: what leaves a task is k rows for each item at most.

Integers are 64-bit; a document's length norm is computed in unbounded integers.

Null texts have no terms and are never found; a null doc_id ranks before others of equal score; rows that repeat are documents of their own;
items with equal id and text are one; items without terms have no rows; no documents or no items give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch
from .text import steps

#: Impacts go up to a million; bytes 1 to 255 are steps of so much.
STEP = -(-1_000_000 // 255)
#: Text bytes of a block of documents; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Rows of items' terms that one pass over the index scores, and sends to every task; an item isn't cut.
PASS_TERMS = 200_000
#: Items whose bounds over a block are held at once.
ITEMS_AT_ONCE = 128

_SCHEMA = "block long, term string, df long, docs array<int>, impacts binary, tfs array<int>, ids array<long>"
#: A-Z to a-z, bytes outside of terms to a space.
_SEPARATED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Index:
    """Posting lists (block, term, df, docs, impacts, tfs, ids) and what they were weighed with."""

    postings: DataFrame
    documents: int
    terms: int


def _terms(batch: pa.RecordBatch) -> list[list[bytes]]:
    """The terms of each text."""
    return [(t or b"").translate(_SEPARATED).split() for t in batch.column("text").cast(pa.large_binary()).to_pylist()]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text", BLOCK_BYTES):
            sizes = [len(t) for t in _terms(part)]
            yield pa.RecordBatch.from_pydict({"documents": [sum(n > 0 for n in sizes)], "terms": [sum(sizes)]})


def norm(sizes: list[int], documents: int, terms: int) -> np.ndarray:
    """The length norm m of documents of these sizes."""
    return np.array([25 + 75 * n * documents // max(terms, 1) for n in sizes], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of tf occurrences in documents of norm m, in millionths."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def index(docs: DataFrame, scratch: Scratch, column: str = "text", key: str = "doc_id") -> Index:
    """The index of all ``docs``: two scans and no shuffle; the rows of a file stand block by block, in order of term."""
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text"))
    found = texts.select("text").mapInArrow(_sizes, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first()
    documents, terms = found[0] or 0, found[1] or 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in steps(batch, "text", BLOCK_BYTES):
                split = _terms(part)
                sizes = [len(t) for t in split]
                own = {"block": [block], "term": [""], "df": [len(sizes)], "docs": [None], "impacts": [None], "tfs": [sizes], "ids": [part.column("id").to_pylist()]}
                lists = _lists(split, norm(sizes, documents, terms))
                yield pa.RecordBatch.from_pydict(own, schema=pa.schema([("block", pa.int64()), *[(f.name, f.type) for f in lists.schema], ("ids", pa.list_(pa.int64()))]))
                if lists.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([block] * lists.num_rows, pa.int64()), *lists.columns, pa.nulls(lists.num_rows, pa.list_(pa.int64()))], _SCHEMA_NAMES)
                block += 1

    return Index(scratch.save(texts.mapInArrow(work, _SCHEMA), "index"), documents, terms)


_SCHEMA_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _lists(split: list[list[bytes]], m: np.ndarray) -> pa.RecordBatch:
    """The posting lists of a block, in order of term."""
    coded = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    doc = np.repeat(np.arange(len(split)), [len(t) for t in split])
    pairs, tf = np.unique(place[coded.indices.to_numpy()] * len(split) + doc, return_counts=True)
    term, doc = pairs // len(split), pairs % len(split)
    df = np.bincount(term, minlength=len(order))
    ends = np.concatenate(([0], np.cumsum(df))).astype(np.int32)
    rounded_up = -(-impact(tf, m[doc]) // STEP)
    columns = {
        "term": coded.dictionary.take(order).cast(pa.string()),
        "df": pa.array(df, pa.int64()),
        "docs": pa.ListArray.from_arrays(ends, pa.array(doc, pa.int32())),
        "impacts": pa.BinaryArray.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(ends), pa.py_buffer(rounded_up.astype(np.uint8))]),
        "tfs": pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
    }
    return pa.RecordBatch.from_pydict(columns)


def item_terms(items: DataFrame, column: str = "text", key: str = "item_id") -> DataFrame:
    """(item, id, term, repeats): the terms of each distinct item; ``item`` is a hash of id and text."""
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.regexp_extract_all(F.translate("text", upper, low), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    name = F.sha2(F.concat_ws(":", F.col("id").isNull().cast("string"), F.col("id").cast("string"), "text"), 256)
    rows = items.select(F.col(key).alias("id"), F.col(column).alias("text")).where("text is not null").withColumn("item", name).dropDuplicates(["item"])
    return rows.select("item", "id", F.explode(found).alias("term")).groupBy("item", "id", "term").agg(F.count("*").alias("repeats"))


class Query:
    """The items of one pass and the weights of their terms, as every task gets them."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["item", "term"])
        self.items = rows["item"].drop_duplicates().tolist()
        numbers = rows["item"].map({x: k for k, x in enumerate(self.items)}).to_numpy(np.int64)
        weights = (rows["repeats"] * rows["w"]).to_numpy(np.int64)
        #: Of each item: its terms and their weights; of each term: its items, ascending, and its weights there.
        self.by_item: list[list[tuple[str, int]]] = [[] for _ in self.items]
        for k, term, weight in zip(numbers.tolist(), rows["term"], weights.tolist(), strict=True):
            self.by_item[k].append((term, weight))
        self.by_term = {t: (numbers[at], weights[at]) for t, at in rows.reset_index(drop=True).groupby("term").indices.items()}

    def bounds(self, lists: pd.DataFrame, documents: int, low: bool) -> Iterator[tuple[int, np.ndarray]]:
        """First item of a slice, and the bounds of its items (rows) over the documents of a block: upper ones, or lower ones."""
        for first in range(0, len(self.items), ITEMS_AT_ONCE):
            out = np.zeros((min(ITEMS_AT_ONCE, len(self.items) - first), documents), np.int64)
            for term, docs, impacts in zip(lists["term"], lists["docs"], lists["impacts"], strict=True):
                item, weight = self.by_term[term]
                a, b = np.searchsorted(item, [first, first + ITEMS_AT_ONCE])
                if a < b:
                    q = np.frombuffer(impacts, np.uint8).astype(np.int64)
                    out[item[a:b, None] - first, docs[None]] += weight[a:b, None] * (np.maximum(q - 1, 0) if low else q) * STEP
            yield first, out

    def score(self, item: int, lists: dict[str, tuple[np.ndarray, np.ndarray]], docs: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Exact scores of one item for some documents of a block, ascending."""
        out = np.zeros(len(docs), np.int64)
        for term, weight in self.by_item[item]:
            if term in lists:
                listed, tfs = lists[term]
                at = np.minimum(np.searchsorted(listed, docs), len(listed) - 1)
                tf = np.where(listed[at] == docs, tfs[at], 0).astype(np.int64)
                out += weight * impact(tf, m)
        return out


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    return np.sort(values)[::-1][:k]


def search(found: Index, items: DataFrame, scratch: Scratch, k: int = 10, column: str = "text", key: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    terms = scratch.save(item_terms(items, column, key), "item-terms")
    passes = max(1, -(-terms.count() // PASS_TERMS))
    parts = [_pass(found, terms.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == n), k) for n in range(passes)]
    return reduce(DataFrame.unionAll, parts).select(F.col("id").alias(key), "rank", "doc_id", "score")


def _pass(found: Index, terms: DataFrame, k: int) -> DataFrame:
    listed = F.broadcast(terms.select("term").distinct())
    df = found.postings.select("term", "df").join(listed, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(found.documents) + 2) / (2 * F.col("df") + 1)))
    query = Query(terms.join(df, "term").select("item", "term", "repeats", weight.alias("w")).toPandas())
    blocks = found.postings.join(F.broadcast(terms.select("term").distinct().union(terms.sparkSession.createDataFrame([("",)], "term string"))), "term", "left_semi")
    best = Window.partitionBy("item")

    def lower_bounds(block: pd.DataFrame) -> pd.DataFrame:
        own = block["term"] == ""
        rows = [(query.items[first + n], x) for first, low in query.bounds(block[~own], int(block.loc[own, "df"].iloc[0]), True) for n, row in enumerate(low) for x in _largest(row[row > 0], k).tolist()]
        return pd.DataFrame({"item": np.array([r[0] for r in rows], object), "low": np.array([r[1] for r in rows], np.int64)})

    lows = blocks.select("block", "term", "df", "docs", "impacts").groupBy("block").applyInPandas(lower_bounds, "item string, low long")
    ranked = lows.withColumn("place", F.row_number().over(best.orderBy(F.desc("low")))).where(F.col("place") <= k)
    least = dict(ranked.where(F.col("place") == k).select("item", "low").toPandas().itertuples(index=False))
    documents, all_terms = found.documents, found.terms

    def exact(block: pd.DataFrame) -> pd.DataFrame:
        own, rows = block["term"] == "", []
        sizes, ids = block.loc[own, "tfs"].iloc[0], block.loc[own, "ids"].iloc[0]
        m, block = norm(np.asarray(sizes).tolist(), documents, all_terms), block[~own]
        lists = dict(zip(block["term"], zip(block["docs"], block["tfs"], strict=True), strict=True))
        known = np.array([x is not None and x == x for x in ids])
        for first, top in query.bounds(block, len(m), False):
            for n, row in enumerate(top):
                docs = np.flatnonzero(row >= max(least.get(query.items[first + n], 1), 1))
                scores = query.score(first + n, lists, docs, m[docs])
                order = sorted((-s, bool(known[d]), int(ids[d]) if known[d] else 0) for s, d in zip(scores.tolist(), docs.tolist(), strict=True) if s > 0)[:k]
                rows += [(query.items[first + n], i if there else None, -s) for s, there, i in order]
        return pd.DataFrame({"item": np.array([r[0] for r in rows], object), "doc_id": pd.array([r[1] for r in rows], "Int64"), "score": np.array([r[2] for r in rows], np.int64)})

    scored = blocks.groupBy("block").applyInPandas(exact, "item string, doc_id long, score long")
    ranked = scored.withColumn("rank", F.row_number().over(best.orderBy(F.desc("score"), F.asc("doc_id")))).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(terms.select("item", "id").distinct()), "item")
