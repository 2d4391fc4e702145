"""Personal data: fixed patterns as seeds, and contextual extraction bootstrapped from them.

Spans of four fixed kinds are the seeds.  The words around a seed induce lexical
patterns (word before, word after, both); each round scores patterns by the
confidence of the values they surround and values by their patterns, over the
graph of pattern-value edges.  Patterns of high confidence mark identifiers that no fixed pattern matches: addresses
written with "at" and "dot", handles and dotted names, numbers in several parts, and tokens with three digits
or more.  Everything is DataFrame functions; expressions are possessive and begin at word starts where a plain form would take
quadratic time on long runs or a stack frame for each repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch
from .spans import all_matches, apart_in_order, joined, located

KINDS = ["email", "ip", "card", "phone"]
ALL_KINDS = [*KINDS, *[f"context_{k}" for k in KINDS]]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_WORD = r"(?<![A-Za-z0-9_+@.-])"
_NAME, _HOST = r"[A-Za-z0-9_+-]++(?:\.[A-Za-z0-9_+-]++)*+", "[A-Za-z0-9-]++"
_AT = r"(?:\x20?[(\[]\x20?(?i:at)\x20?[)\]]\x20?|\x20(?i:at)\x20)"
_DOT = r"(?:(?:\x20?[(\[]\x20?(?i:dot)\x20?[)\]]\x20?|\x20(?i:dot)\x20|\.)" + _HOST + ")"
#: Unseen identifiers: an address in words, a dotted or underscored name or handle, a number in parts, a token with a digit.
TOKEN = "|".join([
    _WORD + _NAME + _AT + _HOST + _DOT + "++",
    _WORD + r"(?=[A-Za-z][A-Za-z+-]*+[0-9._])" + _NAME + _AT + _HOST,
    _WORD + r"@?[A-Za-z]++(?:[._][A-Za-z]++)++(?![A-Za-z0-9_+@-])",
    _WORD + r"[+(]?[0-9]++(?:[\x20().-]{1,2}[0-9]++)*+(?![A-Za-z0-9_+@])",
    r"(?<![A-Za-z0-9_+@-])[A-Za-z_+@-]*+[0-9][A-Za-z0-9_+@-]*+",
])
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(value: str) -> str:
    doubled = "(cast(c AS int) * 2) div 10 + (cast(c AS int) * 2) % 10"
    return f"""aggregate(transform(split(reverse({_digits(value)}), ''), (c, i) -> CASE WHEN c = '' THEN 0 WHEN i % 2 = 1 THEN cast({doubled} AS int) ELSE cast(c AS int) END), 0, (a, x) -> a + x) % 10 = 0"""


#: Windows in which the words around a span are looked for: what the first doesn't hold whole is looked for in the second. Of a word that
#: reaches beyond that, its nearest 4,096 characters stand for it. Long words stand as their hash.
NEAR, FAR, LONG_WORD = 64, 4096, 64


def _chunks(text: str, width: int) -> Column:
    """The text in pieces of ``width`` characters, so that a window is found without a walk from the text's start."""
    return F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{width}}}+"), F.lit(0))


def _before(chunks: str, at: str, width: int) -> str:
    """SQL: the ``width`` characters before place ``at``, fewer at the text's start."""
    k = f"cast({at} div {width} AS int)"
    return f"substring(concat(coalesce(get({chunks}, {k} - 1), ''), substring(coalesce(get({chunks}, {k}), ''), 1, {at} % {width})), -{width})"


def _after(chunks: str, at: str, width: int) -> str:
    """SQL: the ``width`` characters from place ``at``, fewer at the text's end."""
    k = f"cast({at} div {width} AS int)"
    return f"substring(concat(substring(coalesce(get({chunks}, {k}), ''), {at} % {width} + 1), coalesce(get({chunks}, {k} + 1), '')), 1, {width})"


def _nearest(near: str, far: str, found: str, unsure: str) -> str:
    """SQL: the word next to a span, from the window ``near`` or, if that may not hold it whole, from ``far``."""
    word = lambda text: f"lower(regexp_extract({text}, '{found}', 1))"
    case = f"CASE WHEN length({near}) = {NEAR} AND {near} RLIKE '{unsure}' THEN {word(far)} ELSE {word(near)} END"
    return f"transform(array({case}), w -> CASE WHEN length(w) > {LONG_WORD} THEN concat('#', hex(xxhash64(w))) ELSE w END)[0]"


def _context(near: str, far: str, array: str) -> str:
    """SQL: spans of ``array`` with the lower-case word before (b) and after (a) each, '' at an end or where none is in the windows; marks without a letter or digit aren't words.

    ``near`` and ``far`` are columns of the text's pieces of these widths."""
    b = _nearest("z.p", _before(far, "x.s", FAR), r"(?<!\\S)([^\\p{L}\\p{N}\\s]*+[\\p{L}\\p{N}]\\S*+)[^\\p{L}\\p{N}]*+$", r"^\\S*+[^\\p{L}\\p{N}]*+$")
    a = _nearest("z.q", _after(far, "x.e", FAR), r"^[^\\p{L}\\p{N}]*+(\\S++)", r"^[^\\p{L}\\p{N}]*+\\S*+$")
    windows = f"struct({_before(near, 'x.s', NEAR)} AS p, {_after(near, 'x.e', NEAR)} AS q)"
    return f"transform({array}, x -> transform(array({windows}), z -> struct(x.k AS k, x.s AS s, x.e AS e, x.v AS v, {b} AS b, {a} AS a))[0])"


def located_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, tokens) of each row: base spans and other candidates, as arrays of
    (k, s, e, v, b, a): kind in KINDS (-1 for tokens), begin, end, value, the words before and after."""
    step = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    names = ("_e", EMAIL), ("_i", IP), ("_c", CARD), ("_p", PHONE), ("_x", TOKEN)
    for name, regex in names:
        found = all_matches("_t", regex)
        if name == "_e":
            found = F.when(F.contains("_t", F.lit("@")), found).otherwise(F.expr("cast(array() AS array<string>)"))
        step = step.withColumn(name, found)
    for name, regex in names:
        step = step.withColumn(name, located("_t", name, regex))
    n = f"length({_digits('x.v')})"
    holds = {
        "_e": "true",
        "_i": f"x.v RLIKE '^{_PART}([.]{_PART}){{3}}$'",
        "_c": f"{n} BETWEEN 16 AND 19 AND {_luhn('x.v')}",
        "_p": f"{n} BETWEEN 8 AND 15",
    }
    base = ", ".join(f"transform(filter({c}, x -> {rule}), x -> struct({k} AS k, x.s AS s, x.e AS e, x.v AS v))" for k, (c, rule) in enumerate(holds.items()))
    step = step.withColumn("_b", F.expr(f"array_sort(concat({base}))"))
    step = step.withColumn("_x", F.expr(f"filter(_x, x -> {n} >= 3 OR x.v RLIKE '^@|[A-Za-z][._]|[^A-Za-z0-9](?i:at)[^A-Za-z0-9]')"))
    step = step.withColumn("_x", apart_in_order("_x", "_b"))
    step = step.withColumn("_x", F.expr("transform(_x, x -> struct(-1 AS k, x.s AS s, x.e AS e, x.v AS v))"))
    step = step.withColumn("_near", _chunks("_t", NEAR)).withColumn("_far", _chunks("_t", FAR))
    spans = [F.expr(_context("_near", "_far", c)).alias(name) for c, name in (("_b", "base"), ("_x", "tokens"))]
    return step.select("doc_id", F.xxhash64("_t").alias("text_hash"), *spans)


def _patterns() -> Column:
    """The three lexical patterns of an occurrence with words b and a around it."""
    return F.expr("filter(array(CASE WHEN b <> '' THEN concat('B ', b) END, CASE WHEN a <> '' THEN concat('A ', a) END, CASE WHEN a <> '' AND b <> '' THEN concat('C ', b, ' ', a) END), p -> p IS NOT NULL)")


def bootstrap(located_rows: DataFrame, scratch: Scratch, rounds: int = 3, confident: float = 0.8, least_seeds: int = 5, prior: float = 1.0) -> DataFrame:
    """(pattern, kind): patterns of confidence ``confident`` or more after ``rounds`` rounds.

    A pattern's confidence for a kind is the sum of its values' confidences over their
    number plus ``prior``; one with under ``least_seeds`` distinct values of
    positive confidence has none.  A seed's confidence is 1 for its kind; that of any other value is
    one less the product of its confident patterns' doubts.
    """
    spans = located_rows.select(F.explode(F.concat("base", "tokens")).alias("x")).select("x.*")
    edges = scratch.save(
        spans.select(F.explode(_patterns()).alias("pattern"), F.xxhash64("v").alias("value"), "k").groupBy("pattern", "value").agg(F.max("k").alias("k")), "edges"
    )
    kinds = range(len(KINDS))
    zero = [F.when(F.col("k") == k, 1.0).otherwise(0.0).alias(f"c{k}") for k in kinds]
    weighted = edges.select("pattern", "value", *zero)
    kept = None
    for n in range(rounds):
        sums = weighted.groupBy("pattern").agg(F.count("*").alias("n"), *[F.sum(f"c{k}").alias(f"c{k}") for k in kinds], *[F.count_if(F.col(f"c{k}") > 0).alias(f"m{k}") for k in kinds])
        scores = [F.when(F.col(f"m{k}") >= least_seeds, F.col(f"c{k}") / (F.col("n") + prior)).otherwise(0.0).alias(f"s{k}") for k in kinds]
        kept = scratch.save(sums.select("pattern", *scores).where(F.greatest(*[f"s{k}" for k in kinds]) >= confident), f"patterns-{n}")
        if n + 1 < rounds:
            doubt = [F.sum(F.log(F.greatest(1 - F.col(f"s{k}"), F.lit(1e-9)))).alias(f"d{k}") for k in kinds]
            values = edges.where("k < 0").join(kept, "pattern").groupBy("value").agg(*doubt)
            weighted = edges.join(values, "value", "left").select(
                "pattern", "value", *[F.when(F.col("k") == k, 1.0).when(F.col("k") < 0, 1 - F.exp(F.coalesce(f"d{k}", F.lit(0.0)))).otherwise(0.0).alias(f"c{k}") for k in kinds]
            )
    best = F.expr(f"array_position(array({', '.join(f's{k}' for k in kinds)}), greatest({', '.join(f's{k}' for k in kinds)})) - 1")
    return kept.select("pattern", best.cast("int").alias("kind"))


def scan(docs: DataFrame, scratch: Scratch | None = None, **settings: float) -> DataFrame:
    """(doc_id, base, found) for each row of ``docs`` (doc_id, text): arrays of (k, s, e), in order.

    ``base`` has the fixed kinds, ``found`` what confident patterns mark (k is then 4 more than the kind it resembles).
    A null text has no spans; a repeated row comes back as often with the same spans, also where its
    doc_id is null; other columns are ignored.  ``settings`` go to ``bootstrap``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    rows = scratch.save(located_spans(docs), "rows")
    kept = scratch.save(bootstrap(rows, scratch, **settings), "kept")
    tokens = rows.where("size(tokens) > 0").select("doc_id", "text_hash", F.explode("tokens").alias("x"))
    marked = (
        tokens.select("doc_id", "text_hash", "x.*").withColumn("pattern", F.explode(_patterns())).join(kept, "pattern")
        .groupBy("doc_id", "text_hash", "s", "e").agg(F.min("kind").alias("kind"))
        .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct((F.col("kind") + len(KINDS)).alias("k"), "s", "e"))).alias("found"))
    )
    left, right = rows.alias("l"), marked.alias("r")
    both = left.join(right, F.expr("l.doc_id <=> r.doc_id AND l.text_hash = r.text_hash"), "left")
    return both.select("l.doc_id", F.expr("transform(l.base, x -> struct(x.k AS k, x.s AS s, x.e AS e))").alias("base"), F.expr("coalesce(r.found, cast(array() AS array<struct<k:int,s:int,e:int>>))").alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the hash of the base spans and all spans as text."""
    count = lambda k: F.expr(f"cast(size(filter(base, x -> x.k = {k})) AS long)")
    both = scanned.withColumn("_all", F.concat("base", "found"))
    return both.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined("base", ALL_KINDS), 256).alias("base_sha256"), joined("_all", ALL_KINDS).alias("spans"),
    )
