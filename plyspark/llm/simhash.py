"""SimHash near-duplicates, with pigeonring filtering of candidate pairs.

Fingerprints are 64-bit majorities of XXH64 over word shingles.  Documents
link at ``radius`` or fewer differing bits, and components of links are
groups.  The work runs on distinct fingerprints, so copies of a text, however
many, are one node and are never expanded into pairs.

Pigeonring principle: cut 64 bits into m segments on a ring.  If two
fingerprints differ in at most r bits, some segment begins a chain in which,
for every length l, the first l segments differ in at most floor(l * r / m)
bits.  With m = 16 and r = 2 the first seven segments (28 bits) of that chain
are equal, the first fifteen differ in one bit at most, and all in two.
Candidates are grouped by the 28 bits; the chain is checked before the full
distance.  A group of over ``most_group`` fingerprints is grouped anew by
60 bits less one masked bit, where every pair whose chain holds meets; such a
group has at most 32 fingerprints.  A group passes on a forest of its links, not
all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .runtime import Scratch
from .shingles import similar

SEGMENTS = 16
WIDTH = 64 // SEGMENTS
SEED = 42
SPACE = re.compile(rb"[\x20\x09-\x0D]")


#: Bytes of a text whose shingles are hashed, and hashes whose bits are added up, at a time.
TEXT_BLOCK, HASH_BLOCK = 1 << 20, 1 << 16


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks; a word of any length is in one of them."""
    at = 0
    while at < len(data):
        cut = SPACE.search(data, at + TEXT_BLOCK)
        to = cut.start() if cut else len(data)
        yield data[at:to].split()
        at = to


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint: of each bit, whether over half the shingles' hashes have it; a text without words has zero."""
    digest, ones, n, before, short = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, [], []
    for block in _words((text or "").encode().lower()):
        words = before + block
        many = len(words) - shingle + 1
        for at in range(0, many, HASH_BLOCK):
            hashes = np.fromiter((digest(b" ".join(words[i : i + shingle]), SEED) for i in range(at, min(at + HASH_BLOCK, many))), ">u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += max(0, many)
        before = words[-(shingle - 1) :] if shingle > 1 else []
        short = words
    if n == 0:
        return digest(b" ".join(short), SEED) if short else 0
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed long, a row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _rotated(fp: Column | str) -> Column:
    """The fingerprint turned left so that segment i comes first."""
    return F.expr(f"shiftleft({fp}, i * {WIDTH}) | CASE WHEN i = 0 THEN 0L ELSE shiftrightunsigned({fp}, 64 - i * {WIDTH}) END")


def _forests(head: int, budget: list[int]):
    """Of each group, pairs that connect whatever its links connect: one fewer than the members of each of its components.

    Candidates pass the chain's budgets first, segment after segment, then the full distance.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for i, members in zip(batch.column("i").to_pylist(), batch.column("fps").to_pylist(), strict=True):
                fps = np.sort(np.array(members, np.int64)).view(np.uint64)
                a, b = np.triu_indices(len(fps), 1)
                x = fps[a] ^ fps[b]
                turned = (x << np.uint64(i * WIDTH)) | (x >> np.uint64(64 - i * WIDTH) if i else np.uint64(0))
                for n in range(head // WIDTH + 1, SEGMENTS + 1):
                    use = np.bitwise_count(turned >> np.uint64(64 - n * WIDTH)) <= budget[n]
                    a, b, turned = a[use], b[use], turned[use]
                top = list(range(len(fps)))
                for s, t in zip(a.tolist(), b.tolist(), strict=True):
                    while top[s] != s:
                        s = top[s]
                    while top[t] != t:
                        t = top[t]
                    if s != t:
                        top[max(s, t)] = min(s, t)
                signed = fps.view(np.int64)
                out += [(int(signed[top[k]]), int(signed[k])) for k in range(len(fps)) if top[k] != k]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in out], pa.int64()), pa.array([e[1] for e in out], pa.int64())], names=["a", "b"])

    return run


def links(distinct: DataFrame, scratch: Scratch, radius: int = 2, most_group: int = 64) -> DataFrame:
    """(a, b): pairs of fingerprints that connect all that links of ``radius`` or fewer bits (1 or 2) connect.

    ``distinct`` has one column ``fp``, without repeats. Pairs within a group are a forest, so they grow
    with its members, not with their square; a link that is left out is a path of others. No fingerprints, or one, give no links.
    """
    if radius not in (1, 2):
        raise ValueError("radius is 1 or 2: beyond it groups aren't bounded")
    budget = [n * radius // SEGMENTS for n in range(SEGMENTS + 1)]
    head = WIDTH * max(n for n in range(SEGMENTS) if budget[n] == 0)  # equal bits at the chain's start
    tail = WIDTH * max(n for n in range(SEGMENTS) if budget[n] <= 1) - head  # then bits of which one may differ
    chain = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("i")).withColumn("r", _rotated("fp"))
    chain = chain.withColumn("head", F.expr(f"shiftleft(shiftrightunsigned(r, {64 - head}), 4) | i"))
    sizes = chain.groupBy("head").agg(F.count("*").alias("n")).where("n > 1")
    keyed = scratch.save(chain.join(sizes, "head"), "chains")
    if tail:
        few = keyed.where(F.col("n") <= most_group)
        many = (
            keyed.where(F.col("n") > most_group)
            .withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(tail - 1))))
            .withColumn("rest", F.expr(f"shiftrightunsigned(r, {64 - head - tail}) & ~shiftleft(1L, mask) & {(1 << tail) - 1}L"))
        )
        members = many.groupBy("head", "mask", "rest").agg(F.first("i").alias("i"), F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("i", "fps")
    else:
        few, members = keyed, None
    groups = few.groupBy("head").agg(F.first("i").alias("i"), F.collect_list("fp").alias("fps")).select("i", "fps")
    groups = groups if members is None else groups.union(members)
    return groups.mapInArrow(_forests(head, budget), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, fp, component_id): the group of every row of ``docs`` (doc_id, text), named by its least doc_id.

    A null or wordless text has fingerprint zero and links as any other does;
    a null doc_id gets its group's name and names none unless no other row is
    in the group; repeated rows come back as often; no rows give no rows; other columns
    are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, shingle), "rows")
    least = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = scratch.save(links(least.select("fp"), scratch, radius), "links")
    scratch.drop("chains")
    node = connected_components(found, scratch)
    named = least.join(node.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = scratch.save(named, "named")
    group = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(group, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, words: int = 5, similarity: float = 0.8, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of their group, one for each such doc_id.

    Groups are connected by fingerprints within ``radius``, and by shingles of ``words`` words that are alike by ``similarity``
    or more: at the radius that chains can be joined on, fingerprints alone link only texts that are nearly equal.
    Rows that share the doc_id that stays: the one with the least text (null first) stays. Rows with a null doc_id stay, since
    nothing tells them apart.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    rows = docs.where("doc_id IS NOT NULL")
    groups = scratch.save(near_duplicates(rows, shingle, radius, scratch), "groups")
    # each distinct text counts once, by its hash: its copies have one fingerprint, so they are in one group
    names = groups.groupBy("doc_id").agg(F.min("component_id").alias("known"))
    texts = rows.select(F.xxhash64("text").alias("id"), F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    texts = scratch.save(texts.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")).join(names, "doc_id"), "texts")
    found = similar(texts, scratch, words, similarity)
    near = found.join(texts.select(F.col("id").alias("a"), F.col("doc_id").alias("p")), "a").join(texts.select(F.col("id").alias("b"), F.col("doc_id").alias("q")), "b").selectExpr("p AS a", "q AS b")
    by_print = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    node = connected_components(by_print.union(near), scratch)
    drop = scratch.save(node.where("node <> component").select(F.col("node").alias("doc_id")), "drop")
    scratch.drop("rows", "distinct", "named", "groups", "texts")
    plain = rows.join(drop, "doc_id", "left_anti")
    twice = scratch.save(plain.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "twice")
    once = plain.join(twice, "doc_id", "left_anti")
    others = [c for c in docs.columns if c not in ("text", "doc_id")]
    rest = plain.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("row"))
    rest = rest.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"row.{c}").alias(c) for c in docs.columns])
    return once.select(docs.columns).union(rest).union(docs.where("doc_id IS NULL"))
