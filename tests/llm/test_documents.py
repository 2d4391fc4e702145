"""Mixing, decontamination, sharding, near-duplicates, fingerprints, and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plyspark.llm import components, decontam, lcp, mixing, queries, sharding, simhash
from plyspark.llm.runtime import Scratch
from plyspark.llm.shingles import similar

from .conftest import prose

# near-duplicates


def brute_fingerprint(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def union_groups(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(spark, sf_dir, odd, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd.where("doc_id IS NOT NULL").selectExpr("doc_id + 5000", "text"))
    fps = {}
    for r in docs.collect():
        fps[r.doc_id] = brute_fingerprint(r.text, 3)
    ids = sorted(fps)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = union_groups(ids, near)
    docs.createOrReplaceTempView("near_docs")
    rows = simhash.near_duplicates(docs, 3, 2).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.fp & (2**64 - 1) == fps[r.doc_id] and r.component_id == want[r.doc_id]
    assert simhash.near_duplicates(nothing).count() == 0
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert named[30] == named[31] == named[32] == 30 and named[33] == named[34] == 33
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(odd).where("doc_id IS NULL").collect()) == ["30", "None"]


def test_fingerprints_in_blocks_of_words(monkeypatch):
    texts = [prose(1, 5000), "x" * 3000 + " y", "  a\tb  ", "one", "", None, " ".join("ab" for _ in range(999))]
    for text_block, hash_block in ((64, 7), (1, 1 << 16), (1 << 20, 5)):
        monkeypatch.setattr(simhash, "TEXT_BLOCK", text_block)
        monkeypatch.setattr(simhash, "HASH_BLOCK", hash_block)
        for shingle in (1, 3, 4):
            assert [simhash.fingerprint(t, shingle) for t in texts] == [brute_fingerprint(t, shingle) for t in texts]


@pytest.mark.parametrize("radius", [1, 2])
@pytest.mark.parametrize("most_group", [2, 64])
def test_links_connect_all_that_are_near(spark, radius, most_group):
    rng = random.Random(radius)
    fps = {0, 2**64 - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = sorted(map(signed, fps))
    far = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    want = union_groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if far(a, b) <= radius])
    got = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), Scratch(spark, "t"), radius, most_group).collect()]
    assert union_groups(fps, got) == want and len(got) == len(set(got))


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1001), (5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


def jaccard(a, b, n=5):
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (x.lower().split() for x in (a, b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_edited_copies_go_and_others_stay(spark):
    rng, rows, near = random.Random(8), [], []
    for k in range(40):
        base = prose(k, 300).split()
        rows.append((10 * k, " ".join(base)))
        for j in range(1, 4):
            words = list(base)
            for i in rng.sample(range(300), (1, 5, 30)[j - 1]):
                words[i] = "changed"
            rows.append((10 * k + j, " ".join(words)))
    near = {k for k, t in rows if k % 10 and jaccard(t, dict(rows)[k - k % 10]) >= 0.8}
    far = {k for k, t in rows if k % 10 and jaccard(t, dict(rows)[k - k % 10]) < 0.6}
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(near) >= 75 and len(far) >= 39 and len(near & kept) <= 1 and far <= kept and {k for k, _ in rows if k % 10 == 0} <= kept


def test_no_link_between_different_texts_is_lost(spark):
    """Variants of variants, and texts that share most of a template with older unlike ones: as all pairs say."""
    rng, texts = random.Random(9), []

    def edited(words, n):
        out = list(words)
        for i in rng.sample(range(len(out)), n):
            out[i] = f"w{rng.getrandbits(30)}"
        return out

    for k in range(25):
        chain = prose(900 + k, 240).split()
        for _ in range(6):
            texts.append(" ".join(chain))
            chain = edited(chain, 4)
        shared = prose(1900 + k, 200).split()
        for j in range(6):
            text = shared + prose(5000 + 10 * k + j, 60).split()
            texts += [" ".join(text), " ".join(edited(text, 4))] if j else [" ".join(text)]
    fps = [brute_fingerprint(t, 3) for t in texts]
    sets = [set(zip(*[t.split()[i:] for i in range(5)], strict=False)) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 2
    want = union_groups(range(len(texts)), [(i, j) for i in range(len(texts)) for j in range(i) if alike(i, j)])
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept == set(want.values())


class Counting(Scratch):
    """Keeps the number of rows of each table that is saved."""

    def save(self, df, name):
        out = super().save(df, name)
        self.rows = getattr(self, "rows", {}) | {name: out.count()}
        return out


def test_changed_copies_round_one_text_are_not_compared_in_pairs(spark):
    """Each alike only to a text that has neither the least id nor any other sign: pairs grow with the copies, not with their square."""
    rng, base = random.Random(12), prose(12, 149).split()

    def changed(n):
        out = list(base)
        for i in rng.sample(range(5, 140, 6), n):
            out[i] = f"w{rng.getrandbits(30)}"
        return " ".join(out)

    texts = dict(enumerate([changed(3) for _ in range(120)] + [" ".join(base)] + [changed(4) for _ in range(10)]))
    scratch = Counting(spark, "t")
    rows = spark.createDataFrame([(k, t, k) for k, t in texts.items()], "id long, text string, known long")
    found = [(r.a, r.b) for r in similar(rows, scratch, 5, 0.8).collect()]
    want = [(i, j) for i in texts for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(want) < 150 and union_groups(texts, found) == union_groups(texts, want)
    assert scratch.rows["rest"] < 150


def test_one_of_each_group_stays(spark, odd, nothing):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 2 and ids[1] == 1 and ids[33] == 1 and ids[34] == 0 and ids[30] == 1 and ids[31] == 0
    assert simhash.keep_one(nothing).count() == 0


# mixing


def test_mix_meets_targets_and_reruns_agree(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source").union(odd.select(F.col("doc_id") + 10**6, "text", "source"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    texts = docs.collect()
    size = collections.Counter()
    for r in texts:
        size[r.source] += len((r.text or "").encode().split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] >= 2 * size[s]}
        if not more:
            break
        full |= more
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        largest[r.source] = max(largest[r.source], r.size)
        want = 2 * size[r.source] if r.source in full else level * weight[r.source]
        assert r.target == pytest.approx(want) and r.source_size == size[r.source] and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    for s in order:
        want = next(r.target for r in rows if r.source == s)
        # a document that holds most of its source is taken whole or not
        assert abs(taken[s] - want) <= max(2, 0.01 * want, 0.5 * largest[s] if largest[s] > size[s] / 2 else 0)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(nothing).count() == 0
    assert mixing.repeated(nothing, mixing.mix(nothing)).count() == 0


def brute_dual(sizes, target, cap):
    """The root of the words at dual l less the target, by bisection."""
    x, low, high = sizes / sizes.mean(), -60.0, 60.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (sizes * np.minimum(cap, np.exp(middle * x))).sum() < target else (low, middle)
    return low


def test_duals_meet_their_targets(spark):
    rng = np.random.default_rng(3)
    sizes = {"a": rng.integers(1, 60, 3000), "b": (rng.pareto(1.2, 3000) * 20 + 1).astype(int), "c": np.full(500, 7), "d": np.array([5000] + [1] * 300), None: rng.integers(1, 9, 100)}
    share = {"a": 0.4, "b": 1.5, "c": 0.9, "d": 0.3, None: 2.0}
    hist = spark.createDataFrame([(s, int(z), int(n)) for s, own in sizes.items() for z, n in zip(*np.unique(own, return_counts=True), strict=True)], "source string, size long, n long")
    aims = spark.createDataFrame([(s, float(share[s] * own.sum())) for s, own in sizes.items()], "source string, target double")
    duals = {r.source: (r.mean, r.dual) for r in mixing.newton_duals(hist, aims, Scratch(spark, "m"), 2.0).collect()}
    for s, own in sizes.items():
        mean, dual = duals[s]
        rates = np.minimum(2.0, np.exp(np.minimum(700, dual * own / mean)))
        assert mean == pytest.approx(own.mean()) and (own * rates).sum() == pytest.approx(share[s] * own.sum(), rel=1e-6)
        if share[s] < 2:
            assert dual == pytest.approx(brute_dual(own.astype(float), share[s] * own.sum(), 2.0), rel=1e-5, abs=1e-6)


def test_rates_are_tilted_by_size(spark):
    docs = spark.createDataFrame([(k, "w " * (1 + k % 40), "a") for k in range(4000)], "doc_id long, text string, source string")
    for share, longer in ((0.5, False), (1.5, True)):
        rows = mixing.mix(docs, share=share).collect()
        by_size = collections.Counter()
        for r in rows:
            by_size[r.size] += r.copies
        assert sum(r.copies * r.size for r in rows) == pytest.approx(share * sum(r.size for r in rows), rel=0.01)
        rates = [by_size[z] / 100 for z in range(1, 41)]
        want = np.minimum(2, np.exp(brute_dual(np.repeat(np.arange(1.0, 41), 100), share * 100 * np.arange(1, 41).sum(), 2.0) * np.arange(1, 41) / 20.5))
        assert rates == pytest.approx(want, abs=0.02 + 1 / 100) and (rates[-1] > rates[0]) == longer


def test_repeated_and_wordless_rows_are_dealt_apart(spark):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "'two words' AS text", "'a' AS source").union(spark.range(3000).selectExpr("id", "''", "'a'"))
    rows = mixing.mix(docs, share=1.5).collect()
    assert len(rows) == 6000 and sum(r.copies for r in rows) == 4500 and all(r.copies == 0 for r in rows if not r.size)


def test_large_classes_are_dealt_exactly(spark):
    docs = spark.createDataFrame([(k, "same three words", "a") for k in range(9000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, share=1.5).collect()
    assert sum(r.copies for r in rows) == 13_500 and {r.copies for r in rows} == {1, 2}


def test_repeated_rows_follow_the_mix(spark, odd):
    mixed = mixing.mix(odd)
    out = mixing.repeated(odd, mixed)
    assert out.columns == odd.columns and out.count() == mixed.agg(F.sum("copies")).first()[0]
    want, got = collections.Counter(), collections.Counter(r.doc_id for r in out.collect())
    for r in mixed.collect():
        want[r.doc_id] += r.copies
    assert {k: v for k, v in want.items() if v} == dict(got)


# decontamination


def brute_align(item, passage):
    best, before = 0, [0] * (len(passage) + 1)
    for w in item:
        row = [0]
        for j, x in enumerate(passage, 1):
            row.append(max(0, before[j - 1] + (2 if w == x else -1), before[j] - 1, row[j - 1] - 1))
        best, before = max(best, *row), row
    return best


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item, passage = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        score, begin, end = decontam.align(item, passage)
        assert score == brute_align(list(item), list(passage))
        if score:
            assert brute_align(list(item), list(passage[begin:end])) == score


def test_planted_passages_are_found_and_clean_documents_left(spark, odd, nothing):
    items = [(k, prose(900 + k, 25 + k)) for k in range(6)] + [(50, "Too short"), (51, None), (52, "")]
    rng = random.Random(4)
    docs, planted = [], {}
    for k in range(60):
        text = prose(k, 200).split()
        if k % 3 == 0:
            item = rng.randrange(6)
            words = [w if i % 9 else "edited" for i, w in enumerate(items[item][1].split())] if k % 2 else items[item][1].upper().split()
            text[50:50] = [w + "," for w in words]
            planted[k] = item
        docs.append((k, " ".join(text), "extra"))
    docs += [(100, "it was Too, short!", "x"), (101, None, "x"), (None, items[0][1], "x"), (0, docs[0][1], "x")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, passage string")
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {*planted.items(), (100, 50), (None, 0)}
    assert all(50 <= r.first_word <= 52 and r.score >= 0.5 for r in rows if r.doc_id in planted)
    kept = decontam.remove(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == ({*range(60), 101} - {*planted})
    assert decontam.contaminated(odd, items).count() == decontam.contaminated(nothing, items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_items_that_share_an_id_or_have_none_are_all_found(spark):
    texts = [prose(800 + k, 30) for k in range(4)]
    items = spark.createDataFrame([(5, texts[0]), (5, texts[1]), (None, texts[2]), (None, texts[3]), (5, texts[0])], "item_id long, text string")
    docs = [(k, f"{prose(k, 50)} {texts[0] if k < 20 else texts[k - 19]} {prose(100 + k, 50)}") for k in range(23)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect() if r.doc_id < 21) == [(k, 5) for k in range(21)]
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()} == {*((k, 5) for k in range(21)), (21, None), (22, None)}
    assert decontam.remove(docs, items).count() == 0


def test_edited_copies_meet_their_item_beside_verbatim_ones(spark):
    """Every item stands verbatim in one document, and with a word changed in every seventh, fifth, and at random in others: as alignment of all pairs says."""
    rng, docs = random.Random(6), []
    items = [(k, prose(700 + k, 40)) for k in range(12)] + [(20, "".join(chr(0x4E00 + 37 * k % 900) for k in range(30)))]
    for k, text in items:
        words = list(text) if k == 20 else text.split()
        gap = "" if k == 20 else " "
        n = len(words)
        for edits in (set(), set(range(3, n, 7)), set(range(4, n, 5)), *({i for i in range(n) if rng.random() < p} for p in (0.1, 0.15, 0.2))):
            copy = gap.join(("\u4dff" if k == 20 else f"x{rng.getrandbits(30)}") if i in edits else w for i, w in enumerate(words))
            docs.append((len(docs), f"{prose(3000 + len(docs), 80)} {copy} {prose(4000 + len(docs), 80)}"))
    cut = lambda text: [w for x in text.split() for w in (list(x) if ord(x[0]) > 0x3000 else [x])]
    want = set()
    for i, item in items:
        a, ids = cut(item), {}
        a = np.array([ids.setdefault(w, len(ids)) for w in a])
        for d, text in docs:
            score, _, _ = decontam.align(a, np.array([ids.get(w, -1) for w in cut(text)]))
            if score >= len(a):
                want.add((d, i))
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert len(want) >= 70 and {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    pairs = lambda: {(r.doc_id, r.item_id, round(r.score, 6)) for r in decontam.contaminated(docs, items).collect()}
    whole = pairs()
    monkeypatch.setattr(decontam, "BLOCK_GRAMS", 300)
    assert whole and pairs() == whole


# sharding


def test_shards_hold_every_row_once(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(12)
    store = sharding.shard(docs, Scratch(spark, "s").root, target_bytes=200_000)
    out = store.read()
    assert out.exceptAll(docs).count() == docs.exceptAll(out).count() == 0
    live = store.manifest()
    assert store.due(live) == [] and any(s.level for s in live) and max(s.bytes for s in live) < 2.5 * store.target_bytes
    assert store.read(with_shard=True).select("shard_id").distinct().count() == len([s for s in live if s.bytes])
    tagged = sharding.shard(odd, Scratch(spark, "s").root).read(with_shard=True)
    assert tagged.columns == [*odd.columns, "_shard_id", "shard_bytes", "shard_level"] and tagged.select(odd.columns).exceptAll(odd).count() == 0
    for df in (odd, nothing):
        kept = sharding.shard(df, Scratch(spark, "s").root).read()
        assert kept.columns == df.columns and kept.exceptAll(df).count() == df.exceptAll(kept).count() == 0


def test_versions_are_immutable_and_commits_atomic(spark, odd):
    store = sharding.ShardStore(spark, Scratch(spark, "s").root, fan_in=3)
    assert store.read() is None and store.compact() == 0
    for _ in range(3):
        store.append(odd.coalesce(1))
    before = store.manifest(2)
    with pytest.raises(sharding.ConcurrentCommit):
        store.commit(before, 3)
    assert store.compact() == 4 and len(store.manifest()) == 1
    assert store.read().count() == 3 * odd.count() and store.read(2).count() == 2 * odd.count()
    store.vacuum()
    assert store.versions() == [4] and store.read().count() == 3 * odd.count()


# fingerprints


def test_neighbours_equal_brute_force(spark, sf_dir, odd, nothing):
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 100", "text"))
    rows = lcp.neighbours(docs).collect()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    assert collections.Counter(r.doc_id for r in rows) == {k: len(v) for k, v in texts.items()}
    single = sorted(k for k, v in texts.items() if k is not None and k > 1)
    got = {r.doc_id: r for r in rows}
    prints, likes = {}, []
    for k, after in zip(single, [*single[1:], None], strict=True):
        text, follow = texts[k][0], (texts[after][0] if after is not None else None)
        assert got[k].n_chars == len(text)
        if follow is not None:
            cut = len(text) // 4
            edited = text[: len(text) - cut] + follow[:cut]
            assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, got[k].fingerprint) == got[k].fingerprint
        if len(text) > 600 and after is not None:
            likes.append(got[k].near_edited)
            assert got[k].near_edited > got[k].near_next or text == follow
    assert 0.5 < np.mean(likes) < 0.7
    assert lcp.neighbours(nothing).count() == 0
    assert {r.near_next for r in lcp.neighbours(docs.where("doc_id = 5")).collect()} == {1.0}
    plain = {r.doc_id: r.fingerprint for r in lcp.fingerprints(docs).collect()}
    assert all(plain[k] == got[k].fingerprint for k in single)


def test_names_do_not_depend_on_the_offset():
    inner = prose(1, 4000).encode()
    names = []
    for before in (b"", b"some other words first ", b"x"):
        data = np.frombuffer(before + inner, np.uint8)
        symbols, first = data, np.arange(len(data)) == 0
        for _ in range(3):
            symbols, first = lcp._level(symbols, first)
        names.append(set(symbols.tolist()))
    assert len(names[0] & names[1] & names[2]) > 0.98 * len(names[0])


# all together


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pipeline.run(spark, sf)
    assert out.columns == [*docs.columns, "shard_id"] and out.count() > 0
    assert out.drop("shard_id").distinct().exceptAll(docs.distinct()).count() == 0
    bad = decontam.contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert out.join(bad, "doc_id").count() == 0
    assert out.groupBy("text").agg(F.count_distinct("doc_id").alias("n")).where("n > 1").count() == 0
    assert out.groupBy("doc_id").count().where("count > 2").count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_no_rows(spark, sf_dir, odd, nothing, k):
    pipeline = pytest.importorskip("corpus_pipeline")
    _, stage = pipeline.STAGES[k]
    for docs in (odd, nothing):
        out = stage(spark, docs, sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns and (k == 4 or out.columns == docs.columns)
        assert out.select(docs.columns).distinct().exceptAll(docs.distinct()).count() == 0
        assert docs is odd or out.count() == 0


def test_queries_are_registered():
    names = {q.split("_")[0] for q in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 11)}
