"""Language identification, Katz backoff, quality classifier."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyspark.llm import katz, katz_tables, langid, quality, queries
from plyspark.llm.runtime import Scratch
from plyspark.llm.text import utf8, words


def test_words_are_runs_between_the_six_spaces():
    import pyarrow as pa

    texts = ["a  bc d\x0be", None, "", " x", "y ", "\x1cz"]
    data, offsets = utf8(pa.array(texts))
    begin, end, of = words(data, offsets)
    found = [(int(d), data[b:e].tobytes()) for b, e, d in zip(begin, end, of, strict=True)]
    assert found == [(k, w) for k, t in enumerate(texts) for w in (t or "").encode().split()]


def test_language_held_out_accuracy_and_odd_rows(spark, sf_dir, odd, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = queries.op6_langid(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    model = langid.fit(odd)
    out = langid.predict(odd, model)
    assert out.count() == odd.count() and [c for c in out.columns if c != "lang_pred"] == [c for c in odd.columns if c != "score"] + ["score"]
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert got[30] == got[31] == got[32] == got[36] == "und" and got[33] == "en"
    assert langid.predict(nothing, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(nothing)).collect()} == {"und"}


def test_language_filters_have_no_false_negatives(spark):
    docs = spark.createDataFrame([("abcdefgh " * 5, "a"), ("zyxwvuts " * 5, "b"), ("abcdefgh zyxwvuts " * 5, "c")], "text string, lang string")
    model = langid.fit(docs)
    import pyarrow as pa

    grams, of = langid._grams(*utf8(pa.array(["abcdefgh " * 4])))
    hits, total = langid.counted_masks(model, grams, of, 1)
    assert hits[0][0] == total[0] and hits[0][1] < total[0] / 4


def test_filter_grows_with_the_sets(spark):
    """Texts of many distinct n-grams: the fill stays at a half or less, and languages are told apart."""
    rng = np.random.default_rng(5)
    word = lambda low: "".join(chr(low + c) for c in rng.integers(0, 20, 7))
    rows = [(k, " ".join(word(low) for _ in range(3000)), lang) for k in range(6) for low, lang in ((97, "a"), (103, "g"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small, large = langid.fit(docs.where("doc_id = 0").selectExpr("doc_id", "left(text, 2000) AS text", "lang")), langid.fit(docs)
    assert len(large.words) > 8 * len(small.words)
    for model in (small, large):
        assert (model.false_rate <= 0.5**langid.HASHES * 1.01).all()
    held = [(k, " ".join(word(low) for _ in range(60)), lang) for k in range(20) for low, lang in ((97, "a"), (103, "g"))]
    found = langid.predict(spark.createDataFrame(held, "doc_id long, text string, lang string"), large).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.9


def brute_katz(rows, train):
    split = lambda x: (x or "").encode().lower().split() + [None]
    uni, bi, docs = collections.Counter(), collections.Counter(), 0
    for k, x in rows:
        if train(k):
            s = split(x)
            uni.update(s)
            bi.update(zip(["B", *s[:-1]], s, strict=True))
            docs += 1
    total, types = sum(uni.values()), len(uni)
    count_of = lambda c: [sum(1 for v in c.values() if v == r) for r in range(1, 7)]
    d1, d2 = katz.discounts(count_of(uni)), katz.discounts(count_of(bi))
    less = lambda c, d: d[c] * c if c <= 5 else c - 0.5
    p1 = {w: less(c, d1) / total for w, c in uni.items()}
    unknown = 1 - sum(p1.values())
    before, mass, below = collections.Counter(), collections.Counter(), collections.Counter()
    for (h, w), c in bi.items():
        before[h] += c
        mass[h] += less(c, d2)
        below[h] += p1[w]

    def p(h, w):
        if not before[h]:
            return p1.get(w, unknown)
        if (h, w) in bi:
            return less(bi[h, w], d2) / before[h]
        return (1 - mass[h] / before[h]) / (1 - below[h]) * p1.get(w, unknown)

    for h in list(before)[:20]:
        assert abs(sum(p(h, w) for w in uni) + p(h, "never") - 1) < 1e-9
    out = {}
    for k, x in rows:
        s = split(x)
        base = sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (types + 1))) for w in s)
        out.setdefault(k, []).append((len(s), sum(w in uni for w in s), total, base, sum(math.log10(p(h, w)) for h, w in zip(["B", *s[:-1]], s, strict=True))))
    return out


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_katz_equals_brute_force(spark, sf_dir, odd, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_katz(rows, lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 != 0)
    got = collections.defaultdict(list)
    for r in katz.scores(docs, queries.id_remainder(10) != 0).collect():
        got[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(want[k]), sorted(got[k]), strict=True):
            assert a == pytest.approx(b, rel=1e-7, abs=1e-7)


def test_katz_deals_hot_words_and_small_batches(spark, odd, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute_katz(rows, lambda k: k is not None and k % 2 == 0)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = katz.scores(odd, F.col("doc_id") % 2 == 0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(round(r.score, 5) for r in got) == pytest.approx(sorted(round(x[4], 5) for v in want.values() for x in v), abs=1e-4)


def test_stored_tables_score_another_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id < 120")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_katz(rows, lambda k: k % 3 != 0)
    train = docs.where("doc_id % 3 <> 0")
    two = katz_tables.fit(train, Scratch(spark, "k2"), order=2)
    got = {r.rid: r.score for r in katz_tables.score(docs.withColumnRenamed("doc_id", "rid"), two).collect()}
    assert got == pytest.approx({k: v[0][4] for k, v in want.items()}, rel=1e-7)
    three = katz_tables.fit(train, Scratch(spark, "k3"), order=3)
    better = {r.rid: r.score for r in katz_tables.score(docs.withColumnRenamed("doc_id", "rid"), three).collect()}
    assert sum(v for k, v in better.items() if k % 3) > sum(v for k, v in got.items() if k % 3)
    # after any two words seen, all words and the class of unknown ones have probability one
    seen = katz_tables.contexts(train.withColumnRenamed("doc_id", "rid"), 3).select("h1", "h2").distinct().orderBy("h2").limit(15)
    words = three.grams(1).select("w").union(spark.createDataFrame([(12345,)], "w long"))
    totals = katz_tables.probabilities(seen.join(words, F.lit(True)), three).groupBy("h2").agg(F.sum("p").alias("p")).collect()
    assert len(totals) == 15 and [r.p for r in totals] == pytest.approx([1.0] * 15)


def test_stored_tables_with_a_hot_word_and_without_rows(spark, odd, nothing):
    text = " ".join("the" if k % 5 == 0 else f"w{k % 37}" for k in range(2000))
    docs = spark.createDataFrame([(k, text, k) for k in range(6)] + [(6, None, 6), (7, "", 7)], "rid long, text string, w long")
    scores = {r.rid: r.score for r in katz_tables.score(docs, katz_tables.fit(docs, Scratch(spark, "k3"))).collect()}
    assert len({round(scores[k], 9) for k in range(6)}) == 1 and scores[6] == scores[7] > scores[0]
    empty = katz_tables.fit(nothing, Scratch(spark, "k3"))
    assert {r.score for r in katz_tables.score(docs, empty).collect()} == {0.0} and katz_tables.score(docs.limit(0), empty).count() == 0


def test_katz_without_training_rows_or_rows(odd, nothing):
    assert {r.score for r in katz.scores(odd, F.lit(False)).collect()} == {0.0}
    assert katz.scores(nothing, F.lit(True)).count() == 0


def test_good_turing_falls_back_where_counts_are_thin():
    assert katz.discounts([0, 0, 0, 0, 0, 0])[1:] == pytest.approx([(r - 0.5) / r for r in range(1, 6)])
    d = katz.discounts([1000, 300, 150, 90, 60, 45])
    assert all(0 < x < 1 for x in d[1:]) and d == sorted(d[:1] + d[1:], key=lambda x: (x == 1.0, x))[-1:] + d[1:]


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (5, 300, 900, 70_000)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    y, weight = np.array([1, 0, 1, 0]), np.ones(4, np.float32)
    shapes = [(257, quality.EMBED), (quality.WINDOW * quality.EMBED, quality.FILTERS), (quality.FILTERS,), (3 * quality.FILTERS,), (1,)]
    tensors = [rng.normal(0, 0.3, s) for s in shapes]

    def loss():
        model = quality.Model(*tensors[:4], float(tensors[4][0]))
        z = quality.features(model, data, offsets).astype(np.float64) @ tensors[3] + tensors[4][0]
        return np.mean(np.log1p(np.exp(np.where(y == 1, -z, z)))) + 0.5e-4 * (tensors[3] ** 2).sum()

    grads = quality._gradients(tensors, data, offsets, y, weight)
    for t, g in zip(tensors, grads, strict=True):
        for at in np.argsort(-np.abs(g).ravel())[:3]:
            step, flat = 1e-4, t.reshape(-1)
            flat[at] += step
            up = loss()
            flat[at] -= 2 * step
            down = loss()
            flat[at] += step
            assert (up - down) / (2 * step) == pytest.approx(g.ravel()[at], rel=0.05, abs=1e-4)


def test_quality_sample_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(k % 50, f"text {k} " + "x" * 20_000) for k in range(200)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    found = quality.labelled_sample(docs, labels, most_rows=60)
    assert len(found) == 60 and found["text"].is_unique and (found["text"].str.len() > 20_000).all()


def test_quality_reads_every_chunk_and_odd_rows(spark, odd, nothing):
    clean, junk = b"the quiet river runs along the valley " * 8, b"%%% ### $$$ &&& *** !!! " * 12
    model = quality.train([clean, junk, clean[7:], junk[5:]] * 8, np.array([1, 0, 1, 0] * 8), updates=300)
    assert model.embed.shape == (257, quality.EMBED)
    one = lambda t: quality.probability(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
    assert one(clean) > 0.9 > 0.1 > one(junk)
    assert one(clean * 40 + junk * 40) < one(clean * 80)  # what stands at the end counts
    both = quality.probability(model, np.frombuffer(clean + junk, np.uint8), np.array([0, len(clean), len(clean), len(clean + junk)]))
    assert both[0] == pytest.approx(one(clean)) and both[2] == pytest.approx(one(junk)) and 0 <= both[1] <= 1
    out = quality.score(odd, model)
    assert out.count() == odd.count() and sorted(out.columns) == sorted(odd.columns)
    assert quality.score(nothing, model).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality.fit(nothing, labels).intercept == pytest.approx(0)
    assert quality.score(odd, quality.fit(odd, labels)).where("score > 0.5").count() == odd.count()
