"""Data-quality checks: one scan for each table, one shuffle by key for all of them, one row for each check."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import iteration_features, iteration_rollup, search_shares

RATIOS = ["qratio", "tt_hit_ratio", "tt_store_ratio", "fail_high_ratio", "fail_low_ratio", "nmp_ratio"]


@dataclass(frozen=True)
class Source:
    """A table and what each of its rows says: which key it has or needs (code -> domain and key), which values make a duplicate, which rules it breaks."""

    rows: DataFrame
    parent: tuple[str, str] | None = None
    children: dict[str, tuple[str, str]] = field(default_factory=dict)
    duplicates: dict[str, list[str]] = field(default_factory=dict)
    rules: dict[str, Column] = field(default_factory=dict)


def _key(columns: list[str]) -> Column:
    """One text of all values; NULL if a part is."""
    return reduce(lambda a, b: F.concat(a, F.lit("|"), b), [F.col(c).cast("string") for c in columns])


def duplicates(df: DataFrame, keys: list[str]) -> Column:
    """Aggregate: rows beyond the first of each key; a key with a NULL part counts as a duplicate."""
    return F.count("*") - F.count_distinct(_key(keys))


def counted(sources: list[Source]) -> DataFrame:
    """(code, n) of all checks of ``sources``, each scanned once, in one shuffle by key.

    A row of a table becomes a row for each key it has or needs: (domain, key, whether as a parent, for which child check). By
    key, all of them meet in one group, so an orphan is a group that no parent is in; duplicates are the rows of a group beyond
    its first. Rows that break rules are counted beside, in groups that have no key, which each task sums up before the shuffle.
    An orphan check is as NOT IN: a NULL among the parents' keys leaves none, and a NULL key is one only where there are no parents.
    """
    domains = {d: k for k, d in enumerate(dict.fromkeys(x for s in sources for x in [*([s.parent[0]] if s.parent else []), *[d for d, _ in s.children.values()], *s.duplicates]))}
    children = [c for s in sources for c in s.children]
    width = max([len(s.rules) for s in sources] + [1])
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")

    def entry(domain: int, key: Column, bit: int, broken: list[Column] = ()) -> Column:
        marks = [*broken, *[zero] * (width - len(broken))]
        return F.struct(F.lit(domain).alias("domain"), key.alias("key"), F.lit(bit).alias("bit"), *[m.alias(f"r{k}") for k, m in enumerate(marks)])

    parts, rules = [], {}
    for at, s in enumerate(sources):
        entries = [entry(domains[s.parent[0]], F.col(s.parent[1]).cast("string"), 0)] if s.parent else []
        entries += [entry(domains[d], F.col(k).cast("string"), 1 + children.index(code)) for code, (d, k) in s.children.items()]
        entries += [entry(domains[code], _key(columns), 0) for code, columns in s.duplicates.items()]
        if s.rules:
            entries.append(entry(-1 - at, none, 0, [F.when(rule, 1).otherwise(0).cast("long") for rule in s.rules.values()]))
            rules |= {code: (-1 - at, k) for k, code in enumerate(s.rules)}
        parts.append(s.rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    c = F.col
    present = F.bit_or(F.when(c("bit") == 0, 1).otherwise(0)).alias("present")
    groups = reduce(DataFrame.unionAll, parts).groupBy("domain", "key").agg(present, *[F.count_if(c("bit") == b).alias(f"n{b}") for b in range(len(children) + 1)], *[F.sum(f"r{k}").alias(f"r{k}") for k in range(width)])

    def lost(code: str, domain: str) -> Column:
        own, n = c("domain") == domains[domain], c(f"n{1 + children.index(code)}")
        parents, null_parents = F.sum(F.when(own, c("n0")).otherwise(0)), F.sum(F.when(own & c("key").isNull(), c("n0")).otherwise(0))
        without, keyless = F.sum(F.when(own & c("key").isNotNull() & (c("present") == 0), n).otherwise(0)), F.sum(F.when(own & c("key").isNull(), n).otherwise(0))
        return F.when(null_parents > 0, 0).otherwise(without + F.when(parents == 0, keyless).otherwise(0))

    found = {code: lost(code, d) for s in sources for code, (d, _) in s.children.items()}
    # a key with a NULL part is no value: its rows all count
    found |= {code: F.sum(F.when(c("domain") == domains[code], c("n0") - F.when(c("key").isNull(), 0).otherwise(1)).otherwise(0)) for s in sources for code in s.duplicates}
    found |= {code: F.sum(F.when(c("domain") == d, c(f"r{k}")).otherwise(0)) for code, (d, k) in rules.items()}
    sums = groups.agg(*[F.coalesce(n, zero).cast("long").alias(code) for code, n in found.items()])
    stacked = ", ".join(f"'{code}', `{code}`" for code in found)
    return sums.select(F.expr(f"stack({len(found)}, {stacked}) AS (code, n)"))


def orphans(children: DataFrame, key: str, parents: DataFrame, code: str, parent_key: str = "id") -> DataFrame:
    """Children whose key no parent has, by NOT IN's rules for NULL: (code, severity, n)."""
    found = counted([Source(parents, parent=("parents", parent_key)), Source(children, children={code: ("parents", key)})])
    return found.select("code", F.lit("error").alias("severity"), "n")


#: Checks that are errors; the others warn.
ERRORS = ["V01", "V02", "V04", "V09", "V11", "V13", "V14", "V17", "V18"]


def report(searches: DataFrame, engines: DataFrame, iterations: DataFrame, tree: DataFrame, games: DataFrame, timings: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """All checks of the warehouse: (code, severity, n).

    ``features`` is the stored feature table; without it, ratios are those that a search's own row gives, and growth is that of its iterations.
    """
    c = F.col
    lowest = lambda *names: reduce(lambda a, b: a | b, [c(n) < 0 for n in names])
    total = c("nodes") + c("qnodes")
    ratios = {f"V15_{r}": (c(r) < -0.01) | (c(r) > 1.01) for r in RATIOS}
    growth = {"V16": c("avg_ebf") < 0}
    if features is None:
        searches = searches.withColumns(search_shares())
        further = [Source(iteration_rollup(iteration_features(iterations)).select("avg_ebf"), rules=growth)]
    else:
        further = [Source(features, rules=ratios | growth)]
    sources = [
        Source(engines, parent=("engine", "id")),
        Source(searches, parent=("search", "id"), children={"V01": ("engine", "engine_id")}, duplicates={"V08": ["game_id", "ply", "fen", "engine_id"]}, rules={
            "V02": lowest("nodes", "qnodes"), "V03": c("qnodes") > total, "V04": c("time_ms") < 0, "V05": (c("completed_depth") <= 0) | (c("completed_depth") > 100),
            "V06": (c("time_ms") > 0) & (total / F.nullif(c("time_ms") / 1000, F.lit(0.0)) > 1e9), "V07": c("eval").isNull() & (c("completed_depth") > 3),
        } | (ratios if features is None else {})),
        Source(iterations, children={"V09": ("search", "search_id")}, rules={"V10": c("depth") <= 0, "V11": lowest("nodes", "qnodes")}),
        Source(games, rules={"V12": ~c("result").isin("white", "black", "draw"), "V13": c("run_time_s") < 0}),
        Source(tree, children={"V14": ("search", "search_id")}),
        Source(timings, rules={"V17": c("total_time_ms") < 0, "V18": c("num_calls") < 0}),
        *further,
    ]
    n = F.when((c("code") == "V08") & (c("n") <= 100), 0).otherwise(c("n"))
    severity = F.when(c("code").isin(ERRORS), "error").otherwise("warn")
    return counted(sources).select("code", severity.alias("severity"), n.cast("long").alias("n"))


def passed(found: DataFrame) -> DataFrame:
    """One row: whether no error counts, and the numbers of failing checks."""
    bad = lambda s: F.count_if((F.col("severity") == s) & (F.col("n") > 0))
    return found.agg((bad("error") == 0).alias("passed"), bad("error").alias("errors"), bad("warn").alias("warnings"))
