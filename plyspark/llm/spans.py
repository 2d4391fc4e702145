"""Spans of regular-expression matches as native column expressions.

Offsets count code points.  Everything stays in DataFrame functions: the text
is split at the matches, and the lengths of pieces and matches add up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,e:int,v:string>>"


#: Matches are summed in blocks: arrays that grow element by element stay short, so the work is linear in the matches.
BLOCK = 128


def _quoted(regex: str) -> str:
    return regex.replace("\\", "\\\\").replace("'", "\\'")


def located(text: str, matches: str, regex: str) -> Column:
    """Array of (s, e, v) for ``matches``, the column of all matches of ``regex`` in column ``text``, in order."""
    pieces = f"zip_with(slice(split({text}, '{_quoted(regex)}', -1), 1, size({matches})), {matches}, (p, m) -> struct(length(p) AS gap, length(m) AS len, m AS v))"
    blocks = f"transform(array({pieces}), z -> transform(sequence(0, (size(z) - 1) div {BLOCK}), b -> slice(z, cast(b * {BLOCK} + 1 AS int), {BLOCK})))[0]"
    starts = """aggregate(transform(blocks, block -> aggregate(block, 0, (a, x) -> a + x.gap + x.len)),
        struct(0 AS at, cast(array() AS array<int>) AS starts), (acc, n) -> struct(acc.at + n AS at, concat(acc.starts, array(acc.at)) AS starts)).starts"""
    within = f"""aggregate(block, struct(start AS at, cast(array() AS {SPAN}) AS spans),
        (acc, x) -> struct(acc.at + x.gap + x.len AS at, concat(acc.spans, array(struct(acc.at + x.gap AS s, acc.at + x.gap + x.len AS e, x.v AS v))) AS spans)).spans"""
    return F.expr(
        f"CASE WHEN size({matches}) = 0 THEN cast(array() AS {SPAN}) ELSE "
        f"flatten(transform(array({blocks}), blocks -> zip_with(blocks, {starts}, (block, start) -> {within}))[0]) END"
    )


def all_matches(text: str, regex: str, group: int = 0) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(regex), F.lit(group))


def apart(spans: str, base: str) -> Column:
    """The spans that overlap none of ``base``; both are columns of arrays with fields s and e."""
    return F.expr(f"filter({spans}, c -> NOT exists({base}, b -> b.s < c.e AND c.s < b.e))")


def apart_in_order(spans: str, base: str) -> Column:
    """As ``apart``, for spans that are in order and don't overlap each other: a block of about the root of their number meets only the
    base spans in its reach, so long texts don't hold every span against every other."""
    width = "greatest(16, cast(ceil(sqrt(size(x))) AS int))"
    blocks = f"transform(sequence(0, (size(x) - 1) div {width}), i -> slice(x, cast(i * {width} + 1 AS int), {width}))"
    reach = f"filter({base}, b -> b.s < get(block, size(block) - 1).e AND get(block, 0).s < b.e)"
    kept = f"transform(array({reach}), near -> filter(block, c -> NOT exists(near, b -> b.s < c.e AND c.s < b.e)))[0]"
    return F.expr(f"transform(array({spans}), x -> flatten(transform({blocks}, block -> {kept})))[0]")


def joined(spans: str, kinds: list[str]) -> Column:
    """kind:start:end of an array of (.., k, ..) sorted already, comma-joined; k counts from 0 in ``kinds``."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.k + 1), ':', x.s, ':', x.e)), ',')")
