"""Paired tests between two columns: statistics in Spark, p-values from closed forms and series."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import running_total


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return out


def t_two_sided(t: float, n: float) -> float:
    """P(|T| >= |t|) with n degrees of freedom."""
    x, a, b = n / (n + t * t), n / 2, 0.5
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def kolmogorov(lam: float) -> float:
    """P(K > lam) of the limiting distribution."""
    if lam < 0.2:
        return 1.0
    return max(0.0, min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101))))


def rank_sum_exact(w: float, n: int) -> float:
    """Two-sided P of the signed-rank statistic for n pairs without ties."""
    ways = [1] + [0] * (n * (n + 1) // 2)
    for k in range(1, n + 1):
        for s in range(len(ways) - 1, k - 1, -1):
            ways[s] += ways[s - k]
    return min(1.0, 2 * sum(ways[: int(w) + 1]) / 2**n)


def paired_tests(rows: DataFrame, a: str, b: str) -> dict[str, tuple[float, float] | dict | None]:
    """Signed-rank, paired t and two-sample Kolmogorov-Smirnov tests: (statistic, p) each, None where undefined; and a summary.

    Pairs with a NULL or NaN are left out. Ranks and distribution functions run over counts by distinct value, as ranges of Spark's sort;
    the results are a few numbers. Exact for up to 50 pairs without ties (signed-rank), else asymptotic.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    pairs = rows.select(x.alias("x"), y.alias("y")).where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    d = F.col("x") - F.col("y")
    n, mean, sd = pairs.agg(F.count("*"), F.avg(d), F.stddev_samp(d)).first()
    out: dict = {"summary": {"n": n, "mean_diff": mean, "std_diff": sd or 0.0}, "wilcoxon": None, "ttest_rel": None, "ks_2samp": None}
    if n > 1 and sd:
        t = mean / (sd / math.sqrt(n))
        out["ttest_rel"] = (t, t_two_sided(t, n - 1))
    if not n:
        return out
    sizes = pairs.where(d != 0).groupBy(F.abs(d).alias("v")).agg(F.count("*").alias("k"), F.count_if(d > 0).alias("up"))
    ranks = running_total(sizes, ["v"], "k", "upto").withColumn("rank", F.col("upto") - (F.col("k") - 1) / 2)
    m, up, ties, largest = ranks.agg(F.sum("k"), F.sum(F.col("rank") * F.col("up")), F.sum(F.pow("k", F.lit(3)) - F.col("k")), F.max("k")).first()
    if m:
        total = m * (m + 1) / 2
        w = min(up, total - up)
        if m <= 50 and largest == 1:
            p = rank_sum_exact(w, m)
        else:
            spread = math.sqrt((m * (m + 1) * (2 * m + 1) - ties / 2) / 24)
            p = 2 * NormalDist().cdf((w - total / 2) / spread)
        out["wilcoxon"] = (w, min(1.0, p))
    both = pairs.select(F.explode(F.array(F.struct(F.col("x").alias("v"), F.lit(1).alias("s")), F.struct(F.col("y").alias("v"), F.lit(-1).alias("s")))).alias("z")).groupBy("z.v").agg(F.sum("z.s").alias("s"))
    gap = running_total(both, ["v"], "s", "gap").agg(F.max(F.abs("gap"))).first()[0] / n
    out["ks_2samp"] = (gap, kolmogorov(gap * math.sqrt(n / 2)))
    return out
