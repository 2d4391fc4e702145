"""Links between texts whose sets of word shingles are alike, checked on the whole sets.

Prefix filtering: with the shingles of all texts in one order, two sets of sizes m and n that share
``least`` of their union share at least ceil(least * (m + n) / (1 + least)); so the first shingle that both
hold stands early in both (``_may`` says how early), and keying the first fifth or so of
each text's shingles loses no pair.  The order is by how many texts hold a shingle's bucket, rare ones first, so
shared passages and templates are keys only of texts that consist of little else.  It decides the work, not the result.

Comparisons run in rounds: each text with one other, of the leads of its keys and sizes that which it shares most keys with; with the
lead of each of its keys and sizes; with that of a small hand, into which texts of a key and size are dealt by hash, twice; and all texts of a key with each other.
A lead is the text in which the key stands first: it has the fewest rarer shingles, so of copies that were each changed somewhere it is the one changed least, which
more of them are alike to than to one another.  Each round takes only pairs that earlier ones haven't connected, so a group of copies, or of changed ones round a lead, isn't expanded
into pairs, and all others are compared.  A pair is first held against a bitmap of each text's
shingles, a quarter of a byte a shingle, which bounds what the two can share; only texts of pairs that the bound allows are joined and compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .runtime import BATCH_BOUND, BATCH_BYTES, Scratch, settings
from .text import fold, lower, span_hashes, steps, utf8, words

#: Buckets in which shingles are counted, and buckets of a row.
BUCKETS, SLICE = 1 << 22, 1 << 15
#: Texts of a key in a part, about, where all of a key are compared.
PART = 256
#: Bits of a bitmap for each shingle, at least, and bits of the least bitmap.
BITS, LEAST_BITS = 2, 64
#: How often texts of a key are dealt into small hands before all are compared.
DEALS = 2


def shingle_hashes(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words (of all words where a text has fewer) and the texts they are of; A-Z in lower case."""
    data, offsets = utf8(text)
    data = lower(data)
    begin, end, of = words(data, offsets)
    hashes = span_hashes(data, begin, end)
    n = np.bincount(of, minlength=len(offsets) - 1)
    last = np.cumsum(n)
    at = np.arange(len(of))
    out = hashes.copy()
    for k in range(1, size):
        inside = at + k < last[of]
        out[inside] = fold(out[inside], hashes[at[inside] + k])
    full = (at + size <= last[of]) | ((n[of] < size) & (at == last[of] - n[of]))
    return out[full], of[full]


def _sets(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and the texts they are of, in order."""
    h, of = shingle_hashes(part.column("text"), size)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (of[1:] != of[:-1]))) if len(h) else np.zeros(0, bool)
    return h[new], of[new]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for part in steps(batch):
                found, n = np.unique(_bucket(_sets(part, size)[0]), return_counts=True)
                counts[found] += n.astype(np.int32)
        for k in range(0, BUCKETS, SLICE):
            if counts[k : k + SLICE].any():
                yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int32()), pa.array([counts[k : k + SLICE].tobytes()], pa.binary())], names=["slice", "counts"])

    return run


def _added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in rows:
        for k, found in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(found, np.int32).astype(np.int64)
    for k, sums in total.items():
        # eighths of a doubling, in one byte
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.minimum(np.log2(sums + 1) * 8, 255).astype(np.uint8).tobytes()], pa.binary())], names=["slice", "counts"])


def commonness(texts: DataFrame, size: int) -> np.ndarray:
    """Of each bucket of shingles, how many texts hold one of them, as a logarithm: a byte a bucket, whatever the size of ``texts``."""
    parts = texts.select("text").mapInArrow(_counted(size), "slice int, counts binary")
    added = parts.repartition(BUCKETS // SLICE, "slice").mapInArrow(_added, "slice int, counts binary")
    with settings(texts.sparkSession, {BATCH_BOUND: str(BATCH_BYTES)}):
        rows = added.collect()
    out = np.zeros(BUCKETS, np.uint8)
    for r in rows:
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.uint8)
    return out


def _keyed(size: int, least: float, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                h, of = _sets(part, size)
                order = np.lexsort((h, common[_bucket(h)], of))
                h, of = h[order], of[order]
                n = np.bincount(of, minlength=part.num_rows)
                place = np.arange(len(of)) - (np.cumsum(n) - n)[of]
                # a set shares at least ``least`` of its own size with any that is alike
                use = place <= n[of] - np.ceil(least * n[of] - 1e-9)
                of, columns = of[use], [h[use].view(np.int64), place[use].astype(np.int32), n[of[use]].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(of)), *map(pa.array, columns)], names=["id", "key", "place", "n"])

    return run


def _may(least: float) -> str:
    """Whether a text of n shingles and one of n_b can be alike if the first shingle of both stands at place and place_b."""
    return f"least(n - place, n_b - place_b) >= {least / (1 + least)!r} * (n + n_b) - 1e-6"


def _bitmaps(size: int):
    """Of each text the number of its shingles and a bitmap of them, of the least power of two of bits that gives each ``BITS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                h, of = _sets(part, size)
                n = np.bincount(of, minlength=part.num_rows)
                bits = 2 ** np.ceil(np.log2(np.maximum(n * BITS, LEAST_BITS))).astype(np.int64)
                first = np.cumsum(bits) - bits
                marks = np.zeros(int(bits.sum()), bool)
                marks[first[of] + (h % bits[of].astype(np.uint64)).astype(np.int64)] = True
                packed = np.packbits(marks, bitorder="little").tobytes()
                cut = [packed[i : i + k] for i, k in zip((first // 8).tolist(), (bits // 8).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n.astype(np.int32)), pa.array(cut, pa.binary())], names=["id", "n", "bits"])

    return run


def most_shared(n: int, bits: bytes, n_b: int, bits_b: bytes) -> int:
    """The most shingles that two texts can share: each bit that only one of them has is at least one shingle of its own."""
    x, y = np.frombuffer(bits, np.uint64), np.frombuffer(bits_b, np.uint64)
    width = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, width), axis=0) for z in (x, y))
    return min(n - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def _possible(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            four = (batch.column(c).to_pylist() for c in ("n", "bits", "n_b", "bits_b"))
            keep = [most_shared(n, x, m, y) >= least / (1 + least) * (n + m) - 1e-6 for n, x, m, y in zip(*four, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            pa.default_memory_pool().release_unused()

    return run


def _compared(size: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text_b"):
                one, of_one = shingle_hashes(part.column("text"), size)
                two, of_two = shingle_hashes(part.column("text_b"), size)
                cuts = lambda of: np.searchsorted(of, np.arange(part.num_rows + 1))  # noqa: E731, B023
                p, q = cuts(of_one), cuts(of_two)
                keep = np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    x, y = np.unique(one[p[i] : p[i + 1]]), np.unique(two[q[i] : q[i + 1]])
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = both >= least * (len(x) + len(y) - both)
                out = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([out.column("a"), out.column("b")], names=["a", "b"])

    return run


def similar(texts: DataFrame, scratch: Scratch, size: int = 5, least: float = 0.8) -> DataFrame:
    """(a, b): links between rows of ``texts`` (id long, text, known long) that connect all that are alike by ``least`` or more.

    ``known`` names groups that are connected already: rows of one group aren't compared. Ids are unique. Null texts and texts without words have no links; equal
    texts under two ids are alike; no rows give no links.
    """
    keyed = texts.select("id", "text").mapInArrow(_keyed(size, least, commonness(texts, size)), "id long, key long, place int, n int")
    rows = scratch.save(keyed, "keyed")
    texts = _Texts(texts, scratch.save(texts.select("id", "text").mapInArrow(_bitmaps(size), "id long, n int, bits binary"), "bitmaps"))
    twice = rows.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select("key")  # a text has a key once
    rows = scratch.save(rows.join(twice, "key"), "shared")
    scratch.drop("keyed")
    # texts of a key and of like size, with the lead of them
    sized = rows.withColumn("class", _class(least))
    first = _leads(sized, ["key", "class"], ["id", "n"])
    met = sized.join(first, ["key", "class"]).where("id <> id_b").where(_may(least)).groupBy("id", "id_b").agg(F.count("*").alias("keys"))
    met = scratch.save(met, "met")
    groups = texts.rows.select("id", "known")
    # each with the one that it shares most keys with first: what that connects needs no more pairs
    nearest = met.groupBy("id").agg(F.max_by("id_b", F.struct("keys", -F.col("id_b"))).alias("id_b"))
    one = _alike(texts, _apart(nearest, groups), scratch, "0", size, least)
    groups = _joined(groups, one, scratch, "groups-1")
    two = _alike(texts, _apart(met, groups), scratch, "1", size, least)
    groups = _joined(groups, two, scratch, "groups-2")
    now = scratch.save(_undecided(rows, groups), "left-0")
    scratch.drop("shared", "met")
    links = one.union(two)
    for k in range(DEALS):
        found = _alike(texts, _dealt(now, k, least), scratch, f"deal-{k}", size, least)
        groups = _joined(groups, found, scratch, f"groups-deal-{k}")
        now = scratch.save(_undecided(now.drop("known", "held"), groups), f"left-{k + 1}")
        scratch.drop(f"left-{k}")
        links = links.union(found)
    # each text meets all of its key: one side in one part, the other in every part; a key has a part for each PART of its texts
    now = now.withColumn("parts", F.expr(f"cast(ceil(held / {PART}) AS int)")).drop("held")
    other = now.select("key", "parts", *[F.col(c).alias(f"{c}_b") for c in ("id", "known", "place", "n")])
    dealt = now.withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) AS int)")).drop("parts")
    every = other.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    both = dealt.join(every, ["key", "part"]).where("id < id_b AND known <> known_b").where(_may(least)).groupBy(F.col("id").alias("a"), F.col("id_b").alias("b"))
    # what two texts share is the keys they share and, at most, all that comes after the last of these
    found = both.agg(F.count("*").alias("keys"), F.max("place").alias("place"), F.max("place_b").alias("place_b"), F.first("n").alias("n"), F.first("n_b").alias("n_b"))
    rest = found.where(f"keys + least(n - place, n_b - place_b) - 1 >= {least / (1 + least)!r} * (n + n_b) - 1e-6").select("a", "b")
    three = _alike(texts, scratch.save(rest, "rest"), scratch, "2", size, least)
    scratch.drop(f"left-{DEALS}", "rest", "bitmaps")
    return links.union(three)


def _class(least: float) -> Column:
    """Sizes in steps of ``least``."""
    return F.floor(F.log(F.col("n").cast("double")) / float(-np.log(least))).cast("int")


def _leads(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Of the texts of each ``by``, the one in which the key stands first, then of the least id; its ``columns`` and place as ``.._b``."""
    least = rows.groupBy(*by).agg(F.min(F.struct("place", *columns)).alias("r"))
    return least.select(*by, *[F.col(f"r.{c}").alias(f"{c}_b") for c in ("place", *columns)])


def _undecided(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with ``known`` of their texts and the number of texts of their key (held), of keys that texts of several groups hold."""
    now = rows.join(groups, "id")
    several = now.groupBy("key").agg(F.min("known").alias("g"), F.max("known").alias("z"), F.count("*").alias("held")).where("g < z").select("key", "held")
    return now.join(several, "key")


def _dealt(rows: DataFrame, turn: int, least: float, hand: int = 8) -> DataFrame:
    """(a, b): texts of a key and of like size dealt by hash into hands of about ``hand`` or fewer, anew each turn, and each with the lead of its hand: as many pairs as rows at most."""
    dealt = rows.withColumn("class", _class(least)).withColumn("hand", F.expr(f"pmod(xxhash64(id, key, {turn}), greatest(1L, held div {hand}))"))
    lead = _leads(dealt, ["key", "class", "hand"], ["id", "known", "n"])
    met = dealt.join(lead, ["key", "class", "hand"]).where("id <> id_b AND known <> known_b").where(_may(least))
    return met.select(F.col("id_b").alias("a"), F.col("id").alias("b")).distinct()


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b), in order and once, of the ``pairs`` (id, id_b) whose groups differ."""
    two = groups.select(F.col("id").alias("id_b"), F.col("known").alias("known_b"))
    found = pairs.join(groups, "id").join(two, "id_b").where("known <> known_b")
    return found.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b")).distinct()


def _joined(groups: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``groups`` (id, known) after ``links`` (a, b) between their members."""
    of = lambda end, group: groups.select(F.col("id").alias(end), F.col("known").alias(group))
    between = links.join(of("a", "g"), "a").join(of("b", "h"), "b").select(F.col("g").alias("a"), F.col("h").alias("b"))
    node = connected_components(between, scratch).withColumnRenamed("node", "known")
    return scratch.save(groups.join(node, "known", "left").select("id", F.coalesce("component", "known").alias("known")), name)


class _Texts(NamedTuple):
    """Texts (id, text, known), and bitmaps (id, n, bits) of their shingles."""

    rows: DataFrame
    bitmaps: DataFrame


def _ends(pairs: DataFrame, table: DataFrame, columns: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``pairs`` (a, b) with the ``columns`` of their ends in ``table``, those of b as ``.._b``; only rows of ends are saved and joined."""
    held = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    some = scratch.save(table.select("id", *columns).join(held, "id"), name)
    of = lambda end, more: some.select(F.col("id").alias(end), *[F.col(c).alias(c + more) for c in columns])
    return pairs.join(of("a", ""), "a").join(of("b", "_b"), "b").select("a", "b", *columns, *[f"{c}_b" for c in columns])


def _alike(texts: _Texts, pairs: DataFrame, scratch: Scratch, name: str, size: int, least: float) -> DataFrame:
    """The ``pairs`` (a, b) whose texts are alike."""
    pairs = scratch.save(pairs, f"pairs-{name}")
    bounds = _ends(pairs, texts.bitmaps, ["n", "bits"], scratch, f"bits-{name}")
    likely = scratch.save(bounds.mapInArrow(_possible(least), "a long, b long"), f"likely-{name}")
    whole = _ends(likely, texts.rows, ["text"], scratch, f"some-{name}")
    found = scratch.save(whole.mapInArrow(_compared(size, least), "a long, b long"), f"similar-{name}")
    scratch.drop(f"bits-{name}", f"likely-{name}", f"some-{name}", f"pairs-{name}")
    return found
