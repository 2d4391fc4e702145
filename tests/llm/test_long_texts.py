"""Spans and contexts in long texts: the same as by plain expressions, in time that grows with the text."""

import time

from pyspark.sql import functions as F

from plyspark.llm import pii, spans


def test_spans_apart_in_blocks_equal_plain_ones(spark):
    rows = [(k, [(7 * i, 7 * i + 4) for i in range(n)], [(s, s + w) for s, w in held]) for k, (n, held) in enumerate([(0, []), (0, [(1, 2)]), (1, []), (1, [(3, 1)]), (1, [(4, 3)]), (300, [(40, 3), (41, 30), (1000, 300), (1, 1)]), (257, [(7 * i + 3, 2) for i in range(0, 257, 3)])])]
    df = spark.createDataFrame(rows, "id int, x array<struct<s:int,e:int>>, b array<struct<s:int,e:int>>")
    for r in df.select("id", spans.apart_in_order("x", "b").alias("got"), spans.apart("x", "b").alias("plain")).collect():
        assert r.got == r.plain, r.id


def test_windows_equal_slices(spark):
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else chr(97 + i % 26) for i in range(9000))
    df = spark.createDataFrame([(text,), ("",), ("ab",)], "t string").withColumn("c", pii._chunks("t", pii.NEAR)).withColumn("f", pii._chunks("t", pii.FAR))
    df = df.withColumn("at", F.explode(F.expr("filter(array(0, 1, 2, 63, 64, 65, 128, 4095, 4096, 4097, 8192, 8999, 9000), k -> k <= length(t))")))
    found = df.select("t", "at", *[F.expr(f(c, "at", w)).alias(f"{f.__name__}{w}") for f in (pii._before, pii._after) for c, w in (("c", pii.NEAR), ("f", pii.FAR))])
    for r in found.collect():
        for w in (pii.NEAR, pii.FAR):
            assert r[f"_before{w}"] == r.t[max(0, r["at"] - w) : r["at"]], (r["at"], w)
            assert r[f"_after{w}"] == r.t[r["at"] : r["at"] + w], (r["at"], w)


def test_words_beyond_the_windows_are_contexts(spark):
    long = "w" * 5000
    rows = [(1, f"{long} 10.2.3.4 {long}"), (2, "." * 5000 + " 10.2.3.4"), (3, "host " + "-" * 100 + " 10.2.3.4 up")]
    got = {r.doc_id: r.base[0] for r in pii.located_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].b == got[1].a and got[1].b.startswith("#")
    assert (got[2].b, got[2].a) == ("", "")
    assert (got[3].b, got[3].a) == ("host", "up")


def test_time_grows_with_the_text(spark):
    piece = "ip 10.2.3.4 ref abc123 x "
    sizes = {}
    for kb in (1, 200, 400):
        df = spark.createDataFrame([(1, piece * (kb * 1000 // len(piece)))], "doc_id long, text string")
        begin = time.perf_counter()
        row = pii.located_spans(df).collect()[0]
        sizes[kb] = time.perf_counter() - begin
        assert len(row.base) == len(row.tokens) == kb * 1000 // len(piece)
    assert sizes[400] < 2.5 * sizes[200] + 1, sizes
    print(sizes)
