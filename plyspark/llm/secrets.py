"""Secret scans: fixed patterns, and random strings found by two character Markov models.

The model is a pair of first-order character models, one of random strings
and one of ordinary identifiers, trained from labelled samples by counting
transitions; a token's score is the mean log-likelihood ratio of its
transitions.  Everything is DataFrame functions.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import whole_row
from .spans import all_matches, apart, joined, located

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = string.ascii_letters + string.digits + "+/_=-"


def labelled_samples(docs: DataFrame, most_docs: int = 2000, random_strings: int = 4000) -> DataFrame:
    """(text, random): hexadecimal, base-64 and alphanumeric digests as random strings; as
    ordinary identifiers the words of 8 or more characters of the ``most_docs`` documents whose ids hash least,
    without those that hold a pattern of the scan."""
    spark = docs.sparkSession
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    words = chosen.select(F.explode(all_matches("text", r"[A-Za-z0-9+/_=-]{8,}")).alias("text"))
    words = words.where(f"NOT (text RLIKE '{ACCESS}' OR text RLIKE '{HEX}' OR text RLIKE '[0-9].*[0-9]')").distinct()
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id")), 512)
    random = (
        spark.range(random_strings)
        .select(F.explode(F.array(F.substring(digest, 1, 40), F.substring(F.base64(F.unhex(digest)), 1, 40), F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")))).alias("text"))
    )
    return random.withColumn("random", F.lit(True)).union(words.withColumn("random", F.lit(False)))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratios of all transitions between two characters of ALPHABET, row by row.

    Counted in Spark; only the table of at most ``len(ALPHABET)`` squared pairs for each label comes to the driver.
    Null samples and other characters are left out; a label without samples is uniform.
    """
    pair = F.explode(F.expr("transform(sequence(1, length(text) - 1), i -> substring(text, i, 2))"))
    # long samples are cut where they hold a character of no model
    pieces = samples.where("text IS NOT NULL").select("random", F.explode(F.split("text", r"[^A-Za-z0-9+/_=-]+")).alias("text"))
    counts = pieces.where("length(text) > 1").select("random", pair.alias("pair")).groupBy("random", "pair").count().collect()
    n, at = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    table = {True: [smoothing] * (n * n), False: [smoothing] * (n * n)}
    for row in counts:
        table[row["random"]][at[row["pair"][0]] * n + at[row["pair"][1]]] += row["count"]
    total = {k: [sum(v[i * n : (i + 1) * n]) for i in range(n)] for k, v in table.items()}
    return [math.log(table[True][i] / total[True][i // n]) - math.log(table[False][i] / total[False][i // n]) for i in range(n * n)]


def _ratio(token: str, model: list[float]) -> str:
    """SQL of the mean log-likelihood ratio of a token's transitions; linear in its length."""
    values = ",".join(f"{x:.6f}" for x in model)
    n = len(ALPHABET)
    return f"""
      aggregate(
        transform(split({token}, ''), c -> instr('{ALPHABET}', c)),
        struct(0 AS before, 0D AS sum),
        (acc, c) -> struct(c AS before, acc.sum + CASE WHEN acc.before = 0 OR c = 0 THEN 0D ELSE element_at(cast(split('{values}', ',') AS array<double>), (acc.before - 1) * {n} + c) END AS sum),
        acc -> acc.sum / greatest(1, length({token}) - 1)
      )"""


def scan(docs: DataFrame, model: list[float], threshold: float = 0.4) -> DataFrame:
    """``docs`` with arrays ``base`` and ``found`` of (s, k, e, v): begin, kind in KINDS, end, matched text.

    ``base`` is what the three patterns match, ``found`` adds tokens of 16 and more characters whose mean
    ratio is over ``threshold``, with a letter at least, that overlap no base span.  Both are in order of begin, then kind.
    A null text has no spans; repeated rows each come back; other columns stay, and a column
    of ``docs`` called base or found is replaced.
    """
    kept = docs.drop("base", "found")
    step = kept.select(whole_row(kept), F.coalesce("text", F.lit("")).alias("_t"))
    for name, regex in (("_a", ASSIGN), ("_k", ACCESS), ("_h", HEX), ("_m", TOKEN)):
        step = step.withColumn(name, all_matches("_t", regex))
    step = step.withColumn("_g", F.expr("CASE WHEN size(_a) = 0 THEN cast(array() AS array<string>) ELSE regexp_extract_all(_t, '" + ASSIGN.replace("\\", "\\\\").replace("'", "\\'") + "', 2) END"))
    for name, regex in (("_a", ASSIGN), ("_k", ACCESS), ("_h", HEX)):
        step = step.withColumn(name, located("_t", name, regex))
    step = step.withColumn("_a", F.expr("filter(_a, (x, i) -> length(_g[i]) >= 6)"))
    of = lambda name, k: f"transform({name}, x -> struct(x.s AS s, {k} AS k, x.e AS e, x.v AS v))"
    step = step.withColumn("base", F.expr(f"array_sort(concat({of('_a', 0)}, {of('_k', 1)}, {of('_h', 2)}))"))
    # tokens are located only where one scores high
    step = step.withColumn("_high", F.expr(f"transform(_m, x -> x RLIKE '[A-Za-z]' AND {_ratio('x', model)} > {threshold})"))
    step = step.withColumn("_m", F.when(F.expr("exists(_high, x -> x)"), located("_t", "_m", TOKEN)).otherwise(F.expr("cast(array() AS array<struct<s:int,e:int,v:string>>)")))
    step = step.withColumn("_m", F.expr("filter(_m, (x, i) -> _high[i])"))
    step = step.withColumn("_m", apart("_m", "base")).withColumn("found", F.expr(of("_m", 3)))
    return step.select("row.*", "base", "found")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the hash of the base spans and all spans as text."""
    count = lambda k: F.expr(f"cast(size(filter(base, x -> x.k = {k})) AS long)")
    both = scanned.withColumn("_all", F.expr("array_sort(concat(base, found))"))
    return both.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined("base", KINDS), 256).alias("base_sha256"), joined("_all", KINDS).alias("spans"),
    )
