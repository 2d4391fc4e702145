"""Language identification with bit-sliced Bloom filters of byte n-grams.

Training counts the n-grams of every labelled text.  A language's set holds the
n-grams that are at least ``least_share`` as frequent in it as in the language that uses
them most, so a passage of another language in its texts adds nothing.  Sets are
Bloom filters over the same positions; the bits of all languages at a position
stand side by side in one word, so the AND of the words at an n-gram's positions is the mask of all
languages that contain it.  A text's n-grams are looked up and the masks' bits
counted by language; counts are corrected for the share of false positives
that each filter's fill predicts, and the largest decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import Scratch
from .text import lower, mix, steps, utf8

NGRAM = 5
HASHES = 3
UNDETERMINED = "und"
#: Entries of a task's table of counts before it is passed on.
FLUSH = 1 << 20


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # positions x words of 64 languages
    false_rate: np.ndarray  # of each language's filter


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams (NGRAM bytes of 8 bits) of all texts, A-Z in lower case, spaces alike, a run of them as one; the text of each."""
    table = lower(np.arange(256, dtype=np.uint8))
    table[9:14] = 32
    codes = table[data]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[keep]
    codes = codes[keep].astype(np.uint64)
    if len(codes) < NGRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    n = len(codes) - NGRAM + 1
    packed = codes[:n].copy()
    for k in range(1, NGRAM):
        packed <<= np.uint64(8)
        packed |= codes[k : n + k]
    inside = text[:n] == text[NGRAM - 1 :]
    return packed[inside], text[:n][inside]


def _positions(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(grams)
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << bits) - 1)
    return [((h + np.uint64(k) * step) & mask).astype(np.int64) for k in range(HASHES)]


def _counted(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, each pair once or a few times."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return grams, np.bincount(which, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

    def passed() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in texts:
        for part in steps(batch):
            grams, of = _grams(*utf8(part.column("text")))
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[of]
            for k, name in enumerate(names):
                held.setdefault(name, []).append(np.unique(grams[code == k], return_counts=True))
                if len(held[name]) >= 8:
                    held[name] = [merged(held[name])]
            if sum(len(p[0]) for parts in held.values() for p in parts) > FLUSH:
                yield from passed()
    yield from passed()


def fit(docs: DataFrame, least_share: float = 0.1, least_rate: float = 1e-6, scratch: Scratch | None = None) -> Model:
    """A model of all rows of ``docs`` (text, lang) with a text and a lang; repeated rows count as often, further columns are ignored.

    All n-grams of all texts are counted in Spark.  A language's set has those with a share of ``least_rate`` or more of its
    text's bytes, so at most 1 / ``least_rate`` of them at any size of the input.  The filter has a power of two of positions, as many as keep the
    fullest language's at a fill of one half or less; it is what comes to the driver: 64 MB for each 64 languages at most.
    No such rows give a model without languages.
    """
    scratch = scratch or Scratch(docs.sparkSession, "langid")
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counts = known.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total"))
    languages = [x[0] for x in totals.select("lang").orderBy("lang").collect()]
    slices = max(1, -(-len(languages) // 64))
    rates = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.greatest("total", F.lit(1))).where(F.col("rate") >= least_rate)
    place = {x: k for k, x in enumerate(languages)}
    # the languages that hold an n-gram
    by_gram = rates.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("lang", "rate")).alias("uses"))
    chosen = scratch.save(by_gram.select("gram", F.expr(f"transform(filter(uses, x -> x.rate >= {least_share} * most), x -> x.lang)").alias("langs")), "chosen")
    fullest = chosen.select(F.explode("langs").alias("lang")).groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    bits = max(10, math.ceil(math.log2(HASHES * fullest / math.log(2))))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_numpy().view(np.uint64)
            where = _positions(grams, bits)
            words = np.zeros((len(grams), slices), np.uint64)
            for i, langs in enumerate(batch.column("langs").to_pylist()):
                for lang in langs:
                    words[i, place[lang] // 64] |= np.uint64(1 << place[lang] % 64)
            for s in range(slices):
                use = words[:, s] > 0
                for position in where:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(use.sum(), s, np.int32)), pa.array(position[use]), pa.array(words[use, s].view(np.int64))], names=["slice", "position", "word"])

    filled = chosen.mapInArrow(set_bits, "slice int, position long, word long").groupBy("slice", "position").agg(F.bit_or("word").alias("word"))
    words = np.zeros((1 << bits, slices), np.uint64)
    found = filled.toPandas()
    words[found["position"], found["slice"]] = found["word"].to_numpy(np.int64).view(np.uint64)
    fill = np.array([((words[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return Model(languages, words, fill**HASHES)


def counted_masks(model: Model, grams: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts x languages: the n-grams in each language's filter; and the n-grams of each text."""
    bits = int(len(model.words)).bit_length() - 1
    total = np.bincount(of, minlength=texts)
    hits = np.zeros((texts, len(model.languages)))
    where = _positions(grams, bits)
    for s in range(model.words.shape[1]):
        column = np.ascontiguousarray(model.words[:, s])
        masks = column[where[0]]
        for position in where[1:]:
            masks &= column[position]
        for k in range(s * 64, min(len(model.languages), s * 64 + 64)):
            hits[:, k] = np.bincount(of[(masks >> np.uint64(k % 64)) & np.uint64(1) == 1], minlength=texts)
    return hits, total


def decide(model: Model, hits: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language number of each text and its share of the corrected counts; ties go to the first by name."""
    right = np.clip((hits - total[:, None] * model.false_rate) / np.maximum(1 - model.false_rate, 1e-9), 0, None)
    best = right.argmax(axis=1)
    top = right[np.arange(len(right)), best]
    return best, np.where(top > 0, top / np.maximum(right.sum(axis=1), 1e-300), 1 / len(model.languages))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) in place of any of these names.

    ``und`` and 0 where the text is null or has no letter or the model no language; a text with letters
    that shares no n-gram with any language gets the first language with a score of one over their number.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        letter = np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True
        for batch in batches:
            for part in steps(batch):
                data, offsets = utf8(part.column("text"))
                n = part.num_rows
                has = np.add.reduceat(np.append(letter[data], False), offsets[:-1]) > 0
                has &= offsets[:-1] < offsets[1:]
                for i in np.flatnonzero(~has & (np.diff(offsets) > 0)):
                    has[i] = any(c.isalpha() for c in part.column("text")[i].as_py())
                names, score = [UNDETERMINED] * n, np.zeros(n)
                if model.languages:
                    best, share = decide(model, *counted_masks(model, *_grams(data, offsets), n))
                    names = [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
                    score = np.where(has, share, 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(score)], names=[*part.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)
