"""Language-model scores by Katz backoff over words.

A text's tokens are its words (A-Z in lower case) and one end.  A token's probability
after the word before it is the Good-Turing discounted share of that pair if it was seen in training,
and else the backoff weight of the word before times the token's own probability, which is in
turn discounted, with the mass that is left for all unknown words as one class.  Backoff
weights are exact: a word's pairs and what backs off sum to one.

Counts and scores need no dictionary in any task.  Occurrences of pairs are dealt by their
second word into ``parts``, packed into arrays by the task that read the text; a part counts its pairs and
words, and adds what it knows of each document's score.  It passes on, by first word, what
backoff weights need: how many pairs have counts 1, 2, ... and the
probability of their second words, and the pairs not seen in training.  Words of over a quarter of a part's fair
share of all tokens, a few for each part at most, are counted first and dealt by both words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch
from .text import lower, mix, span_hashes, steps, utf8, words

#: Counts up to this are discounted by Good-Turing, larger ones lose REST.
RELIABLE, REST = 5, 0.5
END, START = np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35)
#: Tokens that a task holds before it deals them; documents likewise (16 bits). Tokens of a part.
HELD_TOKENS, HELD_DOCS, PART_TOKENS = 1 << 19, 60_000, 1 << 22


def discounts(counts: list[int]) -> list[float]:
    """d[r] for r = 0..RELIABLE (d[0] unused) from the numbers of things seen 1..RELIABLE + 1 times.

    Good-Turing with Katz's renormalisation; where the counts are too thin for it to lie between 0 and 1, absolute
    discounting by n1 / (n1 + 2 n2).
    """
    n = [0, *counts]
    d = [1.0]
    if all(n[1:]):
        common = (RELIABLE + 1) * n[RELIABLE + 1] / n[1]
        if common < 1:
            d += [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, RELIABLE + 1)]
    if len(d) == 1 or not all(0.02 < x < 1 for x in d[1:]):
        share = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d = [1.0] + [(r - share) / r for r in range(1, RELIABLE + 1)]
    return d


@dataclass
class Unigrams:
    tokens: int
    types: int
    docs: int
    d: list[float]
    unknown: float  # probability of the class of unknown words
    hot: np.ndarray
    hot_counts: np.ndarray

    def probability(self, c: np.ndarray) -> np.ndarray:
        """Of words with training counts ``c``."""
        table = np.array([self.unknown] + [self.d[r] * r / max(1, self.tokens) for r in range(1, RELIABLE + 1)])
        return np.where(c <= RELIABLE, table[np.minimum(c, RELIABLE)], (c - REST) / max(1, self.tokens))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of those before them, and the texts they are of."""
    data, offsets = utf8(column)
    data = lower(data)
    begin, end, of = words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(of, minlength=n)
    ends = np.cumsum(count + 1) - 1
    w = np.empty(len(begin) + n, np.uint64)
    inner = np.ones(len(w), bool)
    inner[ends] = False
    w[inner], w[ends] = span_hashes(data, begin, end), END
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[ends - count] = START
    return w, h, np.repeat(np.arange(n), count + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, n) of a task's texts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        w, which = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        return w, np.bincount(which, np.concatenate([x[1] for x in held]), len(w)).astype(np.int64)

    for batch in batches:
        for part in steps(batch):
            held.append(np.unique(_tokens(part.column("text"))[0], return_counts=True))
            if len(held) >= 8:
                held = [merged()]
                if len(held[0][0]) > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["w", "n"])
                    held = []
    if held:
        w, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["w", "n"])


def count_unigrams(train: DataFrame, scratch: Scratch, parts_of: int) -> tuple[Unigrams, int]:
    """Counts of the tokens of ``train`` (text), saved as table ``unigrams``, and the number of parts for pairs."""
    table = scratch.save(train.select("text").mapInArrow(_counted, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "unigrams")
    row = table.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("w") == int(END.view(np.int64)), F.col("n"))), F.lit(0)),
        *[F.count_if(F.col("n") == r) for r in range(1, RELIABLE + 2)], F.count_if(F.col("n") > RELIABLE),
    ).first()
    tokens, types, docs, *few, rest = row
    d = discounts(list(few))
    left = sum((1 - d[r]) * r * few[r - 1] for r in range(1, RELIABLE + 1)) + REST * rest
    parts = max(parts_of, -(-tokens // PART_TOKENS), 1)
    hot = table.where(F.col("n") > tokens / (4 * parts)).toPandas().sort_values("w")  # 4 * parts rows at most
    values = hot["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return Unigrams(tokens, types, docs, d, left / tokens if tokens else 1.0, values[order], hot["n"].to_numpy(np.int64)[order]), parts


def _is_hot(w: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(w), bool)
    return hot[np.minimum(np.searchsorted(hot, w), len(hot) - 1)] == w


def _six(h: np.ndarray) -> bytes:
    """48-bit numbers as six bytes each."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _stretches(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of an equal key."""
    if not len(sorted_keys):
        return []
    cuts = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_keys)], strict=True))


DEALT = "part long, batch long, w binary, runs binary, h binary, doc binary, n binary, train binary"


def _dealer(hot: np.ndarray, parts: int):
    """Packs a task's pair occurrences by part; ids of its documents go along under a negative part."""
    names = [x.split()[0] for x in DEALT.split(", ")]
    bits = (64 - int(parts).bit_length()) // 2

    def rows(w: np.ndarray, h: np.ndarray, doc: np.ndarray, rids: np.ndarray, train: np.ndarray, batch: int) -> pa.RecordBatch:
        h = h >> np.uint64(16)
        part = w % np.uint64(parts)
        salted = _is_hot(w, hot)
        part[salted] = mix(w[salted] ^ h[salted]) % np.uint64(parts)
        key = (part << np.uint64(2 * bits)) | ((w >> np.uint64(64 - bits)) << np.uint64(bits)) | (h >> np.uint64(max(0, 48 - bits)))
        order = np.argsort(key, kind="stable")
        w, h, doc, part = w[order], h[order], doc[order], part[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(w))).astype(np.uint32)
        w, h, doc, part = w[at], h[at], doc[at].astype(np.uint16), part[at]
        flags = np.packbits(train).tobytes()
        out = [(-1 - batch % parts, batch, b"", b"", b"", rids.tobytes(), b"", flags)]
        for a, b in _stretches(part):
            own = w[a:b]
            run = np.array([x for x, _ in _stretches(own)])
            lengths = np.diff(np.append(run, b - a)).astype(np.uint32)
            out.append((int(part[a]), batch, own[run].tobytes(), _packed(lengths), _six(h[a:b]), doc[a:b].tobytes(), _packed(n[a:b]), flags))
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        tokens = docs = 0

        def flushed() -> pa.RecordBatch:
            starts = np.cumsum([0] + [len(x[3]) for x in held])
            doc = np.concatenate([x[2] + s for x, s in zip(held, starts, strict=False)])
            w, h, rids, train = (np.concatenate([x[k] for x in held]) for k in (0, 1, 3, 4))
            return rows(w, h, doc, rids, train, (task << 24) + count)

        for batch in batches:
            for part in steps(batch):
                for at in range(0, part.num_rows, HELD_DOCS):
                    piece = part.slice(at, HELD_DOCS)
                    if held and (docs + piece.num_rows > HELD_DOCS or tokens > HELD_TOKENS):
                        yield flushed()
                        held, tokens, docs, count = [], 0, 0, count + 1
                    w, h, doc = _tokens(piece.column("text"))
                    held.append((w, h, doc, piece.column("rid").to_numpy(), piece.column("train").to_numpy(zero_copy_only=False)))
                    tokens, docs = tokens + len(w), docs + piece.num_rows
        if held:
            yield flushed()

    return run


TOLD = "kind int, key long, batch long, a binary, b binary, c binary, d binary"
#: Kinds of rows that a part passes on.
IDS, SUMS, TYPES, UNSEEN, SEEN_TIMES = range(5)


def _told(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in TOLD.split(", ")])


#: A part is counted in so many slices by second word, which bounds what a task holds beside its input.
SLICES = 4


def _count_slice(model: Unigrams, w: np.ndarray, h: np.ndarray, n: np.ndarray, trained: np.ndarray) -> tuple:
    """Of pair occurrences (w after h, n times, trained or not): base and model scores, whether w is known, counts of the pairs; and the
    pairs of training as first words, probabilities of the second, and counts up to RELIABLE + 1."""
    pair = mix(w * np.uint64(0x9E3779B97F4A7C15) + h)
    order = np.argsort(pair).astype(np.uint32)
    pair = pair[order]
    first = np.concatenate(([True], pair[1:] != pair[:-1]))
    del pair
    group = (np.cumsum(first) - 1).astype(np.uint32)
    of_pair = np.bincount(group, trained[order]).astype(np.int64)
    seen = np.empty(len(w), np.uint32)
    seen[order] = of_pair[group]
    types, which = np.unique(w, return_inverse=True)
    c = np.bincount(which, trained, len(types)).astype(np.int64)
    hot = _is_hot(types, model.hot)
    c[hot] = model.hot_counts[np.searchsorted(model.hot, types[hot])]
    p = model.probability(c)
    norm = model.tokens + 0.1 * (model.types + 1)
    base = np.log10((c + 0.1) / norm)[which] * n
    score = np.where(seen > RELIABLE, np.log10(np.maximum(seen, 1) - REST), np.where(seen == 0, np.log10(p)[which], 0.0))
    score -= np.where(types == END, 0.0, np.log10(np.maximum(c, 1)))[which]  # as the word before the next token
    score *= n
    held = order[np.flatnonzero(first)[of_pair > 0]]
    return base, score, (c > 0)[which], seen, h[held], p[which[held]], np.minimum(of_pair[of_pair > 0], RELIABLE + 1)


def _counter(model: Unigrams, parts: int):
    """Counts one part's pairs and words, and adds up what it knows of each document."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["part"] < 0:
            return _told([(IDS, r["batch"], r["batch"], r["doc"], b"", b"", b"") for r in rows])
        rows.sort(key=lambda r: r["batch"])
        all_w = np.concatenate([np.repeat(np.frombuffer(r.pop("w"), np.uint64), _unpacked(r.pop("runs"), np.uint32)) for r in rows])
        all_h = np.concatenate([_from_six(r.pop("h")) for r in rows])
        all_n = np.concatenate([_unpacked(r.pop("n"), np.uint32) for r in rows])
        docs = [8 * len(r["train"]) for r in rows]  # documents of each batch, rounded up
        starts = np.cumsum([0, *docs])
        all_doc = np.concatenate([np.frombuffer(r.pop("doc"), np.uint16) + np.uint32(at) for r, at in zip(rows, starts, strict=False)])
        trains = np.concatenate([np.unpackbits(np.frombuffer(r["train"], np.uint8)) for r in rows])
        total = int(starts[-1])
        sums, times = np.zeros((2, total)), np.zeros((RELIABLE + 1, total), np.uint32)
        pairs: list[tuple] = []
        lost: list[tuple] = []
        for k in range(SLICES):
            use = np.flatnonzero((all_w >> np.uint64(20)) % np.uint64(SLICES) == k)
            if not len(use):
                continue
            h, n, doc = all_h[use], all_n[use], all_doc[use]
            base, score, known, seen, *found = _count_slice(model, all_w[use], h, n, n * trains[doc])
            add = lambda x: np.bincount(doc, x, total)  # noqa: E731, B023
            sums += np.stack([add(base), add(score)])
            times += np.stack([add(n * known), *[add(n * (seen == r)) for r in range(1, RELIABLE + 1)]]).astype(np.uint32)
            pairs.append(found)
            new = seen == 0
            lost.append((h[new], n[new], doc[new]))
        del all_w, all_h, all_n, all_doc
        out: list[tuple] = []
        for r, a, b in zip(rows, starts[:-1], starts[1:], strict=True):
            out.append((SUMS, r["batch"], r["batch"], _packed(sums[:, a:b]), _packed(times[:, a:b]), b"", b""))
        # pairs not seen in training, by first word: of which batch and document, and how often
        h, n, doc = (np.concatenate([x[k] for x in lost]) for k in range(3))
        to = h % np.uint64(parts)
        by = np.argsort(to, kind="stable")
        h, n, doc, to = h[by], n[by], doc[by], to[by]
        whose = np.searchsorted(starts, doc, "right") - 1
        for a, b in _stretches(to):
            used, place = np.unique(whose[a:b], return_inverse=True)
            key = (place.astype(np.uint32) << np.uint32(16)) | (doc[a:b] - starts[whose[a:b]]).astype(np.uint32)
            out.append((UNSEEN, int(to[a]), 0, _six(h[a:b]), _packed(key), _packed(n[a:b].astype(np.uint32)), np.array([rows[k]["batch"] for k in used], np.int64).tobytes()))
        # pairs of training by first word
        hh, pp, many = (np.concatenate([x[k] for x in pairs]) for k in range(3))
        out.append((SEEN_TIMES, 0, 0, np.bincount(many, minlength=RELIABLE + 2)[1:].astype(np.int64).tobytes(), b"", b"", b""))
        to = hh % np.uint64(parts)
        by = np.lexsort((hh, to))
        hh, pp, many, to = hh[by], pp[by], many[by], to[by]
        begins = np.flatnonzero(np.concatenate(([True], hh[1:] != hh[:-1]))) if len(hh) else np.zeros(0, np.int64)
        which_h = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(hh))))
        of_times = np.stack([np.bincount(which_h, many == k, len(begins)) for k in range(1, RELIABLE + 2)], axis=1).astype(np.uint32)
        of_p = np.bincount(which_h, pp, len(begins)).astype(np.float32)
        to, hh = to[begins], hh[begins]
        out += [(TYPES, int(to[a]), 0, _six(hh[a:b]), of_p[a:b].tobytes(), _packed(of_times[a:b].T), b"") for a, b in _stretches(to)]
        return _told(out)

    return run


def _backoff(d: list[float]):
    """Corrects scores of unseen pairs: the backoff weight in place of one over the count of the word before.

    With both, that is log10 of the mass left over the probability of words not seen after it; 0 where it was never before a word.
    """
    lost = np.array([(1 - d[r]) * r for r in range(1, RELIABLE + 1)] + [REST])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        unseen = [r for r in rows if r["kind"] == UNSEEN]
        known = [r for r in rows if r["kind"] == TYPES]
        if not unseen or not known:
            return _told([])
        h = np.concatenate([_from_six(r["a"]) for r in known])
        p = np.concatenate([np.frombuffer(r["b"], np.float32) for r in known]).astype(np.float64)
        times = np.concatenate([_unpacked(r["c"], np.uint32).reshape(RELIABLE + 1, -1).T for r in known])
        types, which = np.unique(h, return_inverse=True)
        mass = np.bincount(which, times @ lost, len(types))
        rest = 1 - np.bincount(which, p, len(types))
        weight = np.log10(np.maximum(mass, 1e-300)) - np.log10(np.maximum(rest, 1e-12))
        added: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for r in sorted(unseen, key=lambda r: (r["d"], r["a"])):
            own, key, n = _from_six(r["a"]), _unpacked(r["b"], np.uint32), _unpacked(r["c"], np.uint32)
            at = np.minimum(np.searchsorted(types, own), len(types) - 1)
            add = np.where(types[at] == own, weight[at], 0.0) * n
            for k, batch in enumerate(np.frombuffer(r["d"], np.int64).tolist()):
                use = np.flatnonzero(key >> np.uint32(16) == k)
                added.setdefault(batch, []).append((key[use] & np.uint32(0xFFFF), add[use]))
        out = []
        for batch, found in added.items():
            docs, which_doc = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            out.append((UNSEEN, batch, batch, docs.astype(np.uint16).tobytes(), np.bincount(which_doc, np.concatenate([x[1] for x in found])).tobytes(), b"", b""))
        return _told(out)

    return run


def _finished(d: list[float], start: float):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rids = np.concatenate([np.frombuffer(r["a"], np.int64) for r in rows if r["kind"] == IDS])
        n = len(rids)
        base, score, known = np.zeros(n), np.full(n, start), np.zeros(n, np.int64)
        factor = np.log10([d[r] * r for r in range(1, RELIABLE + 1)])
        for r in sorted(rows, key=lambda r: (r["kind"], r["a"])):
            if r["kind"] == SUMS:
                sums, times = _unpacked(r["a"], np.float64).reshape(2, -1)[:, :n], _unpacked(r["b"], np.uint32).reshape(RELIABLE + 1, -1)[:, :n]
                base += sums[0]
                score += sums[1] + factor @ times[1:]
                known += times[0].astype(np.int64)
            elif r["kind"] == UNSEEN:
                score[np.frombuffer(r["a"], np.uint16)] += np.frombuffer(r["b"], np.float64)
        return pa.Table.from_arrays([pa.array(rids), pa.array(known), pa.array(base), pa.array(score)], names=["rid", "n_known", "base_score", "score"])

    return run


def scores(docs: DataFrame, train: Column, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text).

    ``train`` says of a row whether its text is learned from (null: no). ``base_score`` is that of add-0.1 unigrams, ``score`` the
    model's, both as log10 of the whole text's probability. A null or wordless text is its end alone; repeated rows
    count as often and score alike; without training rows every score is 0; further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "katz")
    rows = docs.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    model, parts = count_unigrams(rows.where("train"), scratch, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select("rid", "train", "text").mapInArrow(_dealer(model.hot, parts), DEALT)
    told = scratch.save(dealt.groupBy("part").applyInArrow(_counter(model, parts), TOLD), "told")
    times = np.zeros(RELIABLE + 1, np.int64)
    for r in told.where(F.col("kind") == SEEN_TIMES).select("a").toLocalIterator():  # a row for each part
        times += np.frombuffer(r["a"], np.int64)
    d = discounts(times.tolist())
    corrected = told.where(F.col("kind").isin(TYPES, UNSEEN)).groupBy("key").applyInArrow(_backoff(d), TOLD)
    sums = told.where(F.col("kind").isin(IDS, SUMS)).union(corrected)
    start = -float(np.log10(model.docs)) if model.docs else 0.0
    found = sums.groupBy("batch").applyInArrow(_finished(d, start), "rid long, n_known long, base_score double, score double")
    found = found.groupBy("rid").agg(F.max("n_known").alias("n_known"), F.max("base_score").alias("base_score"), F.max("score").alias("score"))
    told_of = rows.select("doc_id", "train", "rid", (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long").alias("n_tokens"))
    return told_of.join(found, "rid").select("doc_id", "train", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
