import random
from collections import Counter, defaultdict
from math import floor, log
from zlib import crc32

import duckdb
import numpy as np
import pytest

from plyspark.llm import bm25, bpe, queries, spelling
from plyspark.llm.runtime import Scratch

from .conftest import prose

P = pytest.importorskip("public_tokenizers")


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("library", pat_str=P.PATTERN, mergeable_ranks={b: r for r, b in vocabulary.pieces.items()}, special_tokens={})


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_are_those_of_the_library(vocabulary, library):
    rng = random.Random(1)
    texts = ["", " ", "a", "  \n\t x", "it's THEY'RE don't", " " * 3000 + "x", "=" * 4001, "é" * 1500, "ab" * 2500, "aab" * 1000, "　\x85\x1c\xa0b"]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(4000)), prose(3, 400), vocabulary.newer[:40] + " a" + vocabulary.newer[50:90:3]]
    texts += ["".join(chr(c) for c in rng.choices([*range(0x20, 0x250), *range(0x370, 0x600), *range(0x4E00, 0x4F00), 0x1F600, 0x200D, 0x0A], k=120)) for _ in range(60)]
    coder = bpe.Coder(vocabulary)
    packed = coder.encode(texts)
    assert [ids_of(p) for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert [b.decode() for b in coder.decode(packed)] == texts


def test_every_token_is_made_of_its_own_bytes(vocabulary):
    some = [b for b in list(vocabulary.pieces.values())[::37]]
    assert bpe.Coder(vocabulary)._merged(some) == [np.uint32(r).tobytes() for r in list(vocabulary.pieces)[::37]]


def test_a_merge_before_its_parts_is_refused():
    ranks = {bytes([k]): k for k in range(256)} | {b"abc": 300, b"ab": 301}
    with pytest.raises(ValueError):
        bpe.merge_table(ranks)


def test_encoding_odd_rows(odd, odd_rows, vocabulary, library):
    got = bpe.encoded(odd, vocabulary, decode=True)
    assert got.columns[: len(odd.columns)] == odd.columns
    rows = got.collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert ids_of(row["ids"]) == library.encode_ordinary(row["text"] or "") and row["decoded"].decode() == (row["text"] or "")
    again = bpe.decoded(got.drop("decoded"), vocabulary).select("text", "decoded").collect()
    assert all(r["decoded"].decode() == (r["text"] or "") for r in again)


def test_encoding_nothing_and_clashing_names(spark, nothing, vocabulary):
    assert bpe.digest(nothing, vocabulary).collect() == []
    row = bpe.encoded(spark.createDataFrame([("ab", 1, None)], "text string, ids int, decoded string"), vocabulary, decode=True).first()
    assert row["ids"] == 1 and row["decoded"] is None and row["_decoded"] == b"ab"


# spelling


def words_by_hand(docs, every=97):
    counts = Counter()
    for name, text in docs:
        for run in spelling._RUNS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            h = crc32(f"{'' if name is None else name}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_hand(counts):
    links = defaultdict(list)
    names = sorted(counts)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if near(a, b):
                links[a].append(b)
                links[b].append(a)
    best = {w: min(links[w], key=lambda x: (-counts[x], x)) for w in links}
    form = {w: b for w, b in best.items() if counts[b] >= 2 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(links[w]), counts.get(form.get(w))) for w, n in counts.items()}


def check_spelling(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(frame, Scratch(spark, "test")).collect()}
    want = variants_by_hand(words_by_hand(docs))
    assert got == want
    return want


def small_words(seed, letters, lengths, k):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(k)]


@pytest.mark.parametrize("cell_words", [4096, 7])
def test_variants_equal_brute_force(spark, monkeypatch, cell_words):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell_words)
    rng = random.Random(4)
    pool = small_words(2, "abÿ", (5, 6, 7), 120) + small_words(3, "acgtÀ÷", (5, 8), 150)
    hot = ["aaaaaa" + w for w in small_words(4, "ab", (2, 3), 30)] + [w + "bbbbbb" for w in small_words(5, "ab", (2, 3), 30)] + ["a" * k for k in range(4, 14)]
    docs = [(d, " ".join(rng.choices(pool + hot * 3, k=300)) + ". ABBAa x1y2") for d in range(12)]
    docs += [(None, docs[0][1]), (3, None), (4, ""), docs[1], docs[1]]
    want = check_spelling(spark, docs)
    assert sum(v[0] is not None for v in want.values()) > 20 and max(v[3] for v in want.values()) > 5


def test_variants_of_very_long_words(spark):
    long = "".join(small_words(6, "abcd", (1,), 3000))
    other = long[:1500] + "z" + long[1500:]
    changed = long[:-1] + "z"
    docs = [(k, f"{long} {other} {changed} {long} plain plains") for k in range(4)]
    want = check_spelling(spark, docs)
    assert any(len(w) >= 3000 and v[3] == 2 for w, v in want.items())


def test_variants_of_nothing(spark, nothing):
    assert spelling.variants(nothing, Scratch(spark, "test")).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), Scratch(spark, "test")).collect() == []


def test_variants_of_odd_rows(spark, odd, odd_rows):
    got = {r["word"]: r["n"] for r in spelling.variants(odd, Scratch(spark, "test")).collect()}
    assert got == words_by_hand([(r[0], r[1]) for r in odd_rows])


def test_roots_follow_long_chains(spark):
    rows = spark.createDataFrame([(f"w{k:03}", f"w{k + 1:03}" if k < 70 else None) for k in range(71)], "word string, form string")
    assert {r["root"] for r in spelling.roots(rows, Scratch(spark, "test")).collect()} == {"w070"}


def test_wavelet_tree_reports_ranges():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = spelling.WaveletTree(values)
        left, low = rng.integers(0, n + 1, 50), rng.integers(0, n + 1, 50)
        right, high = np.minimum(left + rng.integers(0, n, 50), n), np.minimum(low + rng.integers(0, n, 50), n)
        query, value = tree.report(left, right, low, high)
        want = {(q, int(v)) for q in range(50) for v in values[left[q] : right[q]] if low[q] <= v < high[q]}
        assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == sorted(want)


def test_a_hot_prefix_is_asked_from_the_other_side():
    rng = random.Random(0)
    words = ["aaaaaaaa" + "".join(rng.choice("bcdefghij") for _ in range(4)) for _ in range(4000)] + small_words(1, "klmnopq", (12,), 4000)
    cells = spelling.Cells([(len(w), w[:24], w[::-1][:24]) for w in words], 100 * spelling.CELL_WORDS)
    assert max(len(cells.questions(w, n)) for w in words for n in (12, 13)) <= 8


# ranked search


def terms_of(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or ord(c) >= 128 else " " for c in text or "").split(" ")


def ranked_by_hand(docs, items, k):
    split = [(d, [t for t in terms_of(x) if t]) for d, x in docs]
    n_docs, n_terms = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = Counter(t for _, ts in split for t in set(ts))
    out = []
    for item, text in set(items):
        scored = []
        for d, ts in split:
            tf, m = Counter(ts), 25 + 75 * len(ts) * n_docs // max(n_terms, 1)
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms_of(text) if t in tf)
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("pass_terms", "block"), [(200_000, 4 << 20), (20, 300)])
def test_search_equals_brute_force(spark, odd, odd_rows, monkeypatch, pass_terms, block):
    monkeypatch.setattr(bm25, "PASS_TERMS", pass_terms)
    monkeypatch.setattr(bm25, "BLOCK_BYTES", block)
    items = [(1, prose(3, 30)), (2, "Ünïcode twice text twice"), (3, None), (4, "!!"), (5, "nowhere to befound"), (1, prose(3, 30)), (None, "ander ander ONE"), (7, prose(9, 12)), (7, "one")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = bm25.index(odd, Scratch(spark, "test"))
    got = sorted(map(tuple, bm25.search(found, frame, Scratch(spark, "test"), k=4).collect()), key=str)
    assert got == ranked_by_hand([(r[0], r[1]) for r in odd_rows], items, 4)


def test_search_of_copies_and_of_nothing(spark, nothing):
    docs = [(k, "alpha beta" if k % 3 else "alpha beta gamma delta " * (k % 5)) for k in range(200, 0, -1)]
    items = [(1, "alpha gamma"), (2, "beta")]
    found = bm25.index(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark, "test"))
    got = sorted(map(tuple, bm25.search(found, spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "test"), k=7).collect()), key=str)
    assert got == ranked_by_hand(docs, items, 7)
    empty = bm25.index(nothing, Scratch(spark, "test"))
    assert bm25.search(empty, spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "test")).collect() == []
    assert bm25.search(found, spark.createDataFrame([], "item_id long, text string"), Scratch(spark, "test")).collect() == []


def test_impacts_bound_scores(spark):
    m = bm25.norm(list(range(0, 4000, 7)), 571, 1_100_000)
    for tf in (1, 2, 9, 100_000):
        exact = bm25.impact(np.full(len(m), tf), m)
        q = -(-exact // bm25.STEP)
        assert (q <= 255).all() and (exact <= q * bm25.STEP).all() and (exact > (q - 1) * bm25.STEP).all()
    assert bm25.norm([10_000_000], 10**11, 10**14)[0] == 25 + 75 * 10**18 // 10**14


@pytest.mark.parametrize("name", ["op12_spelling", "op13_search"])
def test_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(queries.ORACLES[name])
    assert sorted(map(str, frame.select(*want.columns).collect())) == sorted(map(str, (spark_row(want.columns, r) for r in want.fetchall())))


def spark_row(names, values):
    from pyspark.sql import Row

    return Row(**dict(zip(names, values, strict=True)))
