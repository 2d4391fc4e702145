"""Guarded arithmetic and conditional columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as double; NULL where whole is 0."""
    return _col(part).cast("double") / F.nullif(_col(whole).cast("double"), F.lit(0.0))


def ratio_not_one(part: Column | str, whole: Column | str) -> Column:
    """part / whole, NULL where whole is 1; where it is 0, infinite or NaN by the sign of ``part``, as IEEE has it."""
    p, w = _col(part).cast("double"), _col(whole).cast("double")
    return F.when(w == 1, None).otherwise(divided(p, w))


def divided(part: Column | str, whole: Column | str) -> Column:
    """IEEE division: infinite or NaN by zero."""
    p, w = _col(part).cast("double"), _col(whole).cast("double")
    by_zero = F.when(p > 0, F.lit(float("inf"))).when(p < 0, F.lit(float("-inf"))).when(p == 0, F.lit(float("nan")))
    return F.when(w == 0, by_zero).otherwise(p / F.nullif(w, F.lit(0.0)))


def guarded(part: Column | str, whole: Column | str) -> Column:
    """part / whole only where whole is over 0."""
    return F.when(_col(whole) > 0, _col(part).cast("double") / F.nullif(_col(whole).cast("double"), F.lit(0.0)))


def decoded(code: Column | str, names: Mapping[int, str]) -> Column:
    """Names of integer codes, also where these are text; NULL for any other value."""
    number = _col(code).try_cast("int")
    return reduce(lambda c, kv: c.when(number == kv[0], kv[1]), names.items(), F).otherwise(None) if names else F.lit(None)


def last_part(path: Column | str, separator: str = "\\") -> Column:
    """What follows the last ``separator``."""
    return F.element_at(F.split(_col(path), "\\Q" + separator + "\\E"), -1)


def trimmed_part(text: Column | str, separator: str, n: int) -> Column:
    """The n-th part, trimmed; '' where there is none."""
    return F.trim(F.split_part(_col(text), F.lit(separator), F.lit(n)))


def latest_known(value: Column | str, order: str) -> Column:
    """Aggregate: the last value by ``order`` that isn't NULL."""
    v = _col(value)
    return F.max_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), F.col(order)))


def at_or_zero(array: Column | str, i: int) -> Column:
    """The element of a log's array at 0-based i; 0 beyond its end, NULL where the array is or the element is."""
    a = _col(array)
    return F.when(F.size(a) <= i, 0).otherwise(F.get(a, F.lit(i)))


def binned(value: Column | str, step: float, low: float = 0.0) -> Column:
    """The lower edge of the bin of width ``step`` that holds a value."""
    return F.floor((_col(value).cast("double") - low) / step) * step + low


def geo_mean(value: Column | str, natural: bool = True) -> Column:
    """Aggregate: exp(avg(log x)), values not above 0 counting as 1; with ``natural`` False the log is base 10, as the warehouse's tables have it."""
    v = F.when(_col(value) > 0, _col(value)).otherwise(1.0)
    return F.exp(F.avg(F.log(v) if natural else F.log10(v)))


def half_even_int(value: Column | str) -> Column:
    """Double to integer, halves to even."""
    return F.bround(_col(value)).cast("int")


def compact(value: Column | str) -> Column:
    """Text of a count for display: 12.3K, 4.5M, or as it is."""
    v = _col(value)
    short = lambda unit, letter: F.format_string(f"%.1f{letter}", F.round(v / float(unit), 1))
    return F.when(v >= 1_000_000, short(1_000_000, "M")).when(v >= 1000, short(1000, "K")).otherwise(v.cast("string"))


def sample_rows(df, keys: list[str], n: int, seed: int = 42):
    """``n`` rows of least seeded digest of ``keys``: the same rows on every run, and on any engine."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)
