"""Byte-level convolutional quality classifier, trained and applied with numpy.

A document's bytes pass an embedding and filters of ``WINDOW`` bytes that
slide by ``STRIDE``.  Responses are max-pooled over chunks of ``CHUNK`` bytes that
overlap by half and cover the whole document; a document's features are the
mean, the maximum and the minimum of its chunks, and a logistic layer makes one
probability of them.  Training takes a bounded sample of labelled documents
(``most_rows`` of them); training and scores read every chunk of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import steps, utf8

WINDOW, STRIDE, CHUNK, EMBED, FILTERS = 8, 2, 256, 6, 16
HALF = CHUNK // 2 // STRIDE  # filter positions in half a chunk


@dataclass
class Model:
    embed: np.ndarray  # 257 x EMBED, the last for what lies beyond a text
    filters: np.ndarray  # WINDOW * EMBED x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # 3 * FILTERS
    intercept: float


def _windows(codes: np.ndarray) -> np.ndarray:
    """Positions x WINDOW codes; a text takes a whole number of half chunks."""
    return np.lib.stride_tricks.sliding_window_view(codes, WINDOW)[::STRIDE]


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in half chunks, rest filled with code 256, and the half chunks of each."""
    span = HALF * STRIDE
    length = np.diff(offsets)
    halves = np.maximum(2, -(-length // span))
    starts = np.concatenate(([0], np.cumsum(halves)))
    codes = np.full(starts[-1] * span + WINDOW, 256, np.int16)
    to = np.arange(len(data)) + np.repeat(starts[:-1] * span - offsets[:-1], length)
    codes[to] = data
    return codes, starts


def _responses(embed: np.ndarray, filters: np.ndarray, view: np.ndarray, halves: int, step: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """Responses of all filters in half chunks, ``step`` of them at a time."""
    for at in range(0, halves, step):
        part = view[at * HALF : min(at + step, halves) * HALF]
        yield at, (embed[part].reshape(len(part), WINDOW * EMBED) @ filters).reshape(-1, HALF, FILTERS)


def features(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x 3 * FILTERS."""
    codes, starts = _padded(data, offsets)
    view = _windows(codes)[: starts[-1] * HALF]
    halves = np.empty((starts[-1], FILTERS), np.float32)
    for at, x in _responses(model.embed, model.filters, view, starts[-1]):
        halves[at : at + len(x)] = x.max(axis=1)
    halves = np.maximum(halves + model.bias, 0)
    chunks = np.maximum(halves[:-1], halves[1:])
    chunks = np.vstack([chunks, np.zeros((1, FILTERS), np.float32)])
    inside = np.ones(len(chunks), bool)
    inside[starts[1:] - 1] = False  # would span two texts
    return _pooled(chunks[inside], np.diff(starts) - 1)


def _pooled(chunks: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean, maximum and minimum of each document's chunks."""
    begin = np.concatenate(([0], np.cumsum(count)[:-1]))
    mean = np.add.reduceat(chunks, begin, axis=0) / count[:, None]
    return np.hstack([mean, np.maximum.reduceat(chunks, begin, axis=0), np.minimum.reduceat(chunks, begin, axis=0)])


def probability(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    z = features(model, data, offsets).astype(np.float64) @ model.weights + model.intercept
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[bytes], labels: np.ndarray, updates: int = 1536, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on the log loss in ``updates`` steps, however many texts there are; both classes weigh the same.  Without texts of both classes, the share of label 1 is all it learns."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        rng.normal(0, (WINDOW * EMBED) ** -0.5, (WINDOW * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32),
        0.0,
    )
    model.embed[256] = 0
    share = float(np.mean(labels)) if len(labels) else 0.5
    if not len(labels) or share in (0.0, 1.0):
        model.weights[:] = 0
        share = (share * len(labels) + 1) / (len(labels) + 2)
        model.intercept = float(np.log(share / (1 - share)))
        return model
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    tensors = [model.embed, model.filters, model.bias, model.weights, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(t) for t in tensors], [np.zeros_like(t) for t in tensors]
    order = np.zeros(0, np.int64)
    for tick in range(1, updates + 1):
        while len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(texts))])
        rows, order = order[:batch], order[batch:]
        seen = [_cropped(texts[r], rng) if labels[r] == 1 else texts[r] for r in rows]
        data = np.frombuffer(b"".join(seen), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in seen])))
        grads = _gradients(tensors, data, offsets, labels[rows], weight[rows])
        now = rate * (1 - 0.9 * tick / updates)
        for t, g, m, v in zip(tensors, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            t -= now * (m / (1 - 0.9**tick)) / (np.sqrt(v / (1 - 0.999**tick)) + 1e-8)
        tensors[0][256] = 0
    model.intercept = float(tensors[4][0])
    return model


def _cropped(text: bytes, rng: np.random.Generator, share: float = 0.15) -> bytes:
    """A text, or in a ``share`` of cases a few words of it. Any part of a good text is good, so short ones are learned from these; a part of a bad one need not be bad."""
    if rng.random() >= share or len(text) < 40:
        return text
    start = text.find(b" ", rng.integers(0, len(text) - 20)) + 1
    return text[start : start + int(np.exp(rng.uniform(np.log(16), np.log(400))))] or text


def _gradients(tensors: list[np.ndarray], data: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    embed, filters, bias, weights, intercept = tensors
    codes, starts = _padded(data, offsets)
    view = _windows(codes)[: starts[-1] * HALF]
    where, halves = np.empty((starts[-1], FILTERS), np.int64), np.empty((starts[-1], FILTERS), np.float32)
    for at, x in _responses(embed, filters, view, starts[-1]):
        where[at : at + len(x)] = x.argmax(axis=1)
        halves[at : at + len(x)] = x.max(axis=1)
    halves += bias
    live = halves > 0
    halves = np.where(live, halves, 0)
    docs = len(starts) - 1
    count = np.diff(starts) - 1
    of = np.repeat(np.arange(docs), count)  # the document of each chunk
    left = np.concatenate([np.arange(s, e - 1) for s, e in zip(starts[:-1], starts[1:], strict=True)])
    right_wins = halves[left + 1] > halves[left]
    chunks = np.maximum(halves[left], halves[left + 1])
    pooled = _pooled(chunks, count)
    z = pooled @ weights + intercept[0]
    error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / docs).astype(np.float32)
    g_weights = pooled.T @ error + 1e-4 * weights
    g_chunks = (error[:, None] * weights[:FILTERS])[of] / count[of][:, None]
    begin = np.concatenate(([0], np.cumsum(count)[:-1]))
    for k in (1, 2):  # maximum and minimum: shared among the chunks that have it
        at = slice(k * FILTERS, (k + 1) * FILTERS)
        hit = chunks == pooled[of, at]
        hit = hit / np.add.reduceat(hit.astype(np.float32), begin, axis=0)[of]
        g_chunks = g_chunks + (error[:, None] * weights[at])[of] * hit
    g_halves = np.zeros_like(halves)
    np.add.at(g_halves, left, np.where(right_wins, 0, g_chunks))
    np.add.at(g_halves, left + 1, np.where(right_wins, g_chunks, 0))
    g_halves *= live
    position = (np.arange(starts[-1]) * HALF)[:, None] + where
    g_filters, g_embed = np.zeros_like(filters), np.zeros_like(embed)
    for f in range(FILTERS):
        use = np.flatnonzero(g_halves[:, f])
        g, p = g_halves[use, f], position[use, f]
        g_filters[:, f] = embed[view[p]].reshape(len(p), WINDOW * EMBED).T @ g
        np.add.at(g_embed, view[p].ravel(), (g[:, None] * filters[:, f]).reshape(-1, EMBED))
    return [g_embed, g_filters, g_halves.sum(axis=0), g_weights.astype(np.float32), np.array([error.sum()], np.float32)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 4096) -> pd.DataFrame:
    """At most ``most_rows`` training rows (text, label), whole texts: those with the least hash of id and text.

    ``docs`` has the rows that may be learned from; an id that is labelled twice counts with
    its greatest label, null labels and ids not at all; repeated rows count once.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("h"))
    chosen = rows.select("doc_id", "h").join(known, "doc_id").distinct().orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h").limit(most_rows)
    found = rows.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).toPandas()
    return found.sort_values(["doc_id", "h"], ignore_index=True)[["text", "label"]]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 4096) -> Model:
    """A model of ``labels`` (doc_id, label 0 or 1), trained on the driver from at most ``most_rows`` labelled documents, each read whole."""
    found = labelled_sample(docs, labels, label, most_rows)
    return train([t.encode() for t in found["text"]], found["label"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a column named ``column`` (double, 0 to 1) in place of any of that name.

    A null text scores as an empty one; every row comes back, in its partition, with its other columns as they were.
    """
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                data, offsets = utf8(part.column("text"))
                found = probability(model, data, offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, column])

    return docs.mapInArrow(run, schema)
