"""Byte-level BPE: encoding by recursive merges in DuckDB inside each task, decoding by ordered aggregation.

A text is split by the tokenizer's pattern, as its own library would split it.
In each task the distinct words become rows (place, word, id), one for a byte.
A recursive query joins neighbours with the merge table and contracts, word by
word, the pair of least rank until no pair of a word merges.  Where the least
pair stands several times in a word, all its places are contracted in one
step, in a run of equal tokens every other one from the left: this is what
contracting the leftmost first comes to, since a merge only makes pairs of
higher rank (``merge_table`` checks that of the vocabulary).  So a run of
100,000 equal characters takes as many steps as it has ranks, not places.

Null texts are empty and have no ids; repeated rows each come back; texts of
any length are read whole; no rows give none; the new columns take underscores
before their names where the table has those names.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import free
from .text import steps

#: Bytes of words that one recursive query takes; a longer word is a query of its own.
QUERY_BYTES = 1 << 20
#: Text bytes of one step, and ids of one decoding query.
STEP = 4 << 20
#: Encoded words that a Python worker keeps between tasks; beyond, it starts anew.
KEPT_WORDS = 800_000

_ENCODE = """
WITH RECURSIVE step AS (
  SELECT place, word, id, 0 AS round FROM bytes
  UNION ALL
  (WITH pairs AS (
     SELECT s.place, s.word, s.next_place, m.merged, m.twin
     FROM (SELECT place, word, id, lead(place) OVER w AS next_place, lead(id) OVER w AS next_id, lead(word) OVER w AS next_word
           FROM step WINDOW w AS (ORDER BY place)) s
     JOIN merges m ON m.pair = s.id * 4294967296 + s.next_id
     WHERE next_word = word),
   least AS (
     SELECT p.* FROM pairs p JOIN (SELECT word, min(merged) AS merged FROM pairs GROUP BY word) USING (word, merged)),
   taken AS (
     SELECT place, word, next_place, merged FROM least WHERE NOT twin
     UNION ALL
     SELECT place, word, next_place, merged FROM (
       SELECT *, row_number() OVER (PARTITION BY word, run ORDER BY place) AS k FROM (
         SELECT *, place - (next_place - place) * row_number() OVER (PARTITION BY word ORDER BY place) AS run FROM least WHERE twin))
     WHERE k % 2 = 1)
   SELECT s.place, s.word, coalesce(t.merged, s.id), s.round + 1
   FROM step s LEFT JOIN taken t ON t.place = s.place
   WHERE s.word IN (SELECT word FROM taken) AND s.place NOT IN (SELECT next_place FROM taken)))
SELECT place, word, id, round FROM step
"""
_DECODE = "SELECT text, array_to_string(list(piece ORDER BY place), '') AS decoded FROM tokens JOIN pieces USING (id) GROUP BY text"


@dataclass(frozen=True)
class Vocabulary:
    """A rank file: the bytes of each id, and which two ids make a third."""

    pieces: dict[int, bytes]
    pairs: np.ndarray
    merged: np.ndarray
    twins: np.ndarray
    #: Ids of the 256 bytes.
    single: np.ndarray
    pattern: str
    #: Characters that the splitting library knows as letters or digits and the tokenizer's doesn't yet.
    newer: str
    key: str


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, merged): for each token the two that its own bytes are contracted to last.

    No other two tokens of those bytes ever stand side by side: the merges within a part of a text come in the order in
    which they come in that part alone.  Raises ValueError where a merge has a lower rank than one of its two parts.
    """
    rows = []
    for token, rank in ranks.items():
        if len(token) == 1:
            continue
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            found = [(r, k) for k in range(len(parts) - 1) if (r := ranks.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 2:
            left, right = ranks[parts[0]], ranks[parts[1]]
            if rank <= max(left, right):
                raise ValueError(f"token {rank} merges before its parts")
            rows.append((left, right, rank))
    return rows


def load(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a rank file (base64 of a token, space, rank, a line each), read on the driver; its size is the file's."""
    with open(path, "rb") as file:
        content = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    rows = np.array(merge_table(ranks), np.int64).reshape(-1, 3)
    single = np.array([ranks[bytes([k])] for k in range(256)], np.int64)
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    return Vocabulary({r: t for t, r in ranks.items()}, (rows[:, 0] << 32) + rows[:, 1], rows[:, 2], rows[:, 0] == rows[:, 1], single, pattern, _newer(), key)


def _newer() -> str:
    """Letters and digits of ``regex`` that the tokenizer's library takes for other characters, since its Unicode tables are older."""
    import regex
    import tiktoken

    bytes_alone = {bytes([k]): k for k in range(256)}
    probe = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=bytes_alone, special_tokens={})
    known = regex.compile(r"[\p{L}\p{N}]")
    unsettled = (chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
    return "".join(c for c in unsettled if known.match(c) and not probe.encode_ordinary(c))


class Coder:
    """Encodes and decodes within a task; a worker process keeps its tables and words from task to task."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary = vocabulary
        kept = sys.modules.setdefault(f"_plyspark_bpe_{vocabulary.key}", types.ModuleType("kept")).__dict__
        if "words" not in kept:
            kept["words"], kept["duckdb"] = {}, self._database()
        self.words, self.duckdb = kept["words"], kept["duckdb"]
        self.split = regex.compile(vocabulary.pattern).findall
        # a stand-in that is neither letter, digit nor space, as those characters are to the tokenizer
        self.stand_in = dict.fromkeys(map(ord, vocabulary.newer), "\ue000")
        self.newer = frozenset(vocabulary.newer)

    def _database(self):
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        v = self.vocabulary
        merges = pa.table({"pair": v.pairs, "merged": v.merged, "twin": pa.array(v.twins)})  # noqa: F841
        # bytes as the characters of the same numbers, since strings can be joined and binary values can't
        pieces = pa.table({"id": pa.array(list(v.pieces), pa.int64()), "piece": pa.array([b.decode("latin-1") for b in v.pieces.values()])})  # noqa: F841
        con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        con.execute("CREATE TABLE pieces AS SELECT * FROM pieces")
        return con

    def split_words(self, text: str) -> list[str]:
        if text.isascii() or self.newer.isdisjoint(text):
            return self.split(text)
        words, at = [], 0
        for word in self.split(text.translate(self.stand_in)):
            words.append(text[at : at + len(word)])
            at += len(word)
        return words

    def _merged(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        number = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        self.duckdb.register("bytes", pa.table({"place": np.arange(len(data)), "word": number, "id": self.vocabulary.single[data]}))
        found = self.duckdb.sql(_ENCODE).to_arrow_table()
        self.duckdb.unregister("bytes")
        place, word, ids, rounds = (found.column(c).to_numpy() for c in ("place", "word", "id", "round"))
        last = np.zeros(len(words), rounds.dtype)
        np.maximum.at(last, word, rounds)
        final = np.flatnonzero(rounds == last[word])
        final = final[np.argsort(place[final])]
        packed, ends = ids[final].astype("<u4").tobytes(), np.cumsum(np.bincount(word[final], minlength=len(words))) * 4
        return [packed[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split_words(t) for t in texts]
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        new = sorted(set().union(*split).difference(self.words), key=len)
        block, size = [], 0
        for word in new:
            if block and size + len(word) > QUERY_BYTES // 2:
                self._encode_block(block)
                block, size = [], 0
            block.append(word)
            size += len(word)
        self._encode_block(block)
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def _encode_block(self, words: list[str]) -> None:
        if words:
            self.words.update(zip(words, self._merged([w.encode() for w in words]), strict=True))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        lengths = np.array([len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        out = [b""] * len(ids)
        if len(flat):
            text = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
            self.duckdb.register("tokens", pa.table({"text": text, "place": np.arange(len(flat)), "id": flat}))
            found = self.duckdb.sql(_DECODE).to_arrow_table()
            self.duckdb.unregister("tokens")
            for k, decoded in zip(found.column("text").to_pylist(), found.column("decoded").to_pylist(), strict=True):
                out[k] = decoded.encode("latin-1")
        return out


def encoded(docs: DataFrame, vocabulary: Vocabulary, column: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit integers) and, if asked for, ``decoded``, the bytes those ids stand for."""
    ids, decoded = free("ids", docs), free("decoded", docs)
    names = [ids, decoded] if decode else [ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            for part in steps(batch, column, STEP):
                found = [coder.encode([t or "" for t in part.column(column).to_pylist()])]
                if decode:
                    found.append(coder.decode(found[0]))
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(x, pa.binary()) for x in found]], [*part.schema.names, *names])

    schema = docs.select("*", *[F.lit(b"").alias(n) for n in names]).schema
    return docs.mapInArrow(work, schema)


def decoded(table: DataFrame, vocabulary: Vocabulary, column: str = "ids") -> DataFrame:
    """``table`` with ``decoded``, the bytes that the ids of a column like that of ``encoded`` stand for; null ids are none."""
    name = free("decoded", table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            for part in steps(batch, column, STEP):
                found = coder.decode([x or b"" for x in part.column(column).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*part.schema.names, name])

    return table.mapInArrow(work, table.select("*", F.lit(b"").alias(name)).schema)


def digest(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text, encoded and decoded again."""
    found = encoded(docs.select("doc_id", "text"), vocabulary, decode=True)
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
