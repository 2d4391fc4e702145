"""Ratings of match results as column expressions over wins, draws and losses."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rating of the first engine and the least rating.
ANCHOR, FLOOR = 1500.0, 100.0


def elo_to_score(elo: Column) -> Column:
    return 1.0 / (1.0 + F.pow(F.lit(10.0), -elo / 400.0))


def score_to_elo(score: Column) -> Column:
    """0 for a score of 0 or less, 800 for 1 or more."""
    inner = F.when((score > 0) & (score < 1), score)
    return F.when(score <= 0, 0.0).when(score >= 1, 800.0).otherwise(-400.0 * F.log10(1.0 / inner - 1.0))


def half_width(variance: Column, level: float = 0.95) -> Column:
    return F.lit(NormalDist().inv_cdf(1 - (1 - level) / 2)) * F.sqrt(variance)


def naive_elo(w: Column, losses: Column) -> Column:
    return F.when((w == 0) | (losses == 0), 0.0).otherwise(400.0 * F.log10(w / F.nullif(losses, F.lit(0))))


def match_score(w: Column, d: Column, losses: Column) -> Column:
    """Share of points; one half without games."""
    n = w + d + losses
    return F.when(n == 0, 0.5).otherwise((w + d / 2.0) / F.nullif(n, F.lit(0)))


class _Smoothed:
    """Half a game more of each outcome, and what follows from it."""

    def __init__(self, w: Column, d: Column, losses: Column):
        self.w, self.d, self.l = w + 0.5, d + 0.5, losses + 0.5
        self.n = self.w + self.d + self.l
        odds_win, odds_loss = self.w / (self.n - self.w), self.l / (self.n - self.l)
        self.bayes = 200.0 * F.log10(odds_win / odds_loss)
        self.draw = -200.0 * F.log10(odds_win * odds_loss)
        x = F.pow(F.lit(10.0), -self.draw / 400.0)
        self.scale = 4.0 * x / F.pow(1.0 + x, F.lit(2.0))

    def chances(self, bayes: Column) -> tuple[Column, Column, Column]:
        win = elo_to_score(bayes - self.draw)
        loss = elo_to_score(-bayes - self.draw)
        return win, 1.0 - win - loss, loss


def log_likelihood_ratio(w: Column, d: Column, losses: Column, elo0: float, elo1: float) -> Column:
    """Of two rating differences, for a sequential test; 0 without games or where a model leaves no chance to an outcome."""
    s = _Smoothed(w, d, losses)
    zero, one = s.chances(elo0 / s.scale), s.chances(elo1 / s.scale)
    possible = (F.least(*zero) > 0) & (F.least(*one) > 0)
    terms = [n * F.log(F.when(b > 0, b) / F.when(a > 0, a)) for n, a, b in zip((s.w, s.d, s.l), zero, one, strict=True)]
    return F.when((w + d + losses > 0) & possible, terms[0] + terms[1] + terms[2]).otherwise(0.0)


def bounds(alpha: float, beta: float) -> tuple[Column, Column]:
    return F.log(F.lit(beta / (1 - alpha))), F.log(F.lit((1 - beta) / alpha))


def decision(llr: Column, low: Column, high: Column) -> Column:
    return F.when(llr >= high, "pass").when(llr <= low, "fail").otherwise("inconclusive")


def _interval(score: Column, variance: Column, level: float, scale: Column, middle: Column) -> Column:
    ci = half_width(F.greatest(variance, F.lit(0.0)), level)
    low, high = F.greatest(F.lit(0.001), score - ci), F.least(F.lit(0.999), score + ci)
    flat = variance <= 0
    return F.struct(
        middle.alias("elo"),
        F.when(flat, middle).otherwise(score_to_elo(low) * scale).alias("low"),
        F.when(flat, middle).otherwise(score_to_elo(high) * scale).alias("high"),
    )


def _none() -> Column:
    return F.struct(F.lit(0.0).alias("elo"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"))


def elo_interval(w: Column, d: Column, losses: Column, level: float = 0.95) -> Column:
    """struct(elo, low, high) of the logistic rating difference; zeros without games."""
    n = F.nullif(w + d + losses, F.lit(0))
    s = (w + d / 2.0) / n
    found = _interval(s, ((w + d / 4.0) / n - s * s) / n, level, F.lit(1.0), score_to_elo(s))
    return F.when(w + d + losses == 0, _none()).otherwise(found)


def bayes_elo_interval(w: Column, d: Column, losses: Column, level: float = 0.95) -> Column:
    s = _Smoothed(w, d, losses)
    score = (s.w + s.d / 2.0) / s.n
    found = _interval(score, ((s.w + s.d / 4.0) / s.n - score * score) / s.n, level, s.scale, s.bayes * s.scale)
    return F.when(w + d + losses == 0, _none()).otherwise(found)


def normalized_elo_interval(w: Column, d: Column, losses: Column, level: float = 0.95) -> Column:
    """The rating difference in units of half a game's standard deviation; zeros for no games or only wins or losses."""
    n = F.nullif(w + d + losses, F.lit(0))
    mean = (w + d / 2.0) / n
    variance = (w * F.pow(1 - mean, F.lit(2.0)) + d * F.pow(0.5 - mean, F.lit(2.0)) + losses * mean * mean) / n
    scale = F.when(variance > 0, F.sqrt(F.lit(0.25) / F.when(variance > 0, variance))).otherwise(1.0)
    found = _interval(mean, ((w + d / 4.0) / n - mean * mean) / n, level, scale, score_to_elo(mean) * scale)
    return F.when((w + d + losses == 0) | (mean <= 0) | (mean >= 1), _none()).otherwise(found)


def normal_cdf(z: Column) -> Column:
    """P(Z <= z) of a standard normal, by its series z + z^3/3 + z^5/(3 5) + ... times the density; 0 or 1 beyond 8."""

    def series(v: Column) -> Column:
        step = lambda acc, k: F.struct((acc["term"] * v * v / (2 * k + 1)).alias("term"), (acc["sum"] + acc["term"] * v * v / (2 * k + 1)).alias("sum"))
        total = F.aggregate(F.sequence(F.lit(1), F.lit(150)), F.struct(v.alias("term"), v.alias("sum")), step, lambda acc: acc["sum"])
        return F.when(v > 8, 1.0).when(v < -8, 0.0).otherwise(0.5 + total * F.exp(-v * v / 2) / math.sqrt(2 * math.pi))

    return F.get(F.transform(F.array(z.cast("double")), series), F.lit(0))


def likelihood_of_superiority(w: Column, losses: Column) -> Column:
    """struct(los, low, high) in percent from decisive games, one unit of 1.96 either way; 50, 0, 100 without any."""
    n = w + losses
    z = (w - losses) / F.sqrt(2.0 * F.nullif(n, F.lit(0)))
    z = F.coalesce(z, F.lit(0.0))
    one = lambda shift, none: F.when(n == 0, none).otherwise(100 * normal_cdf(z + shift))
    return F.struct(one(0.0, 50.0).alias("los"), one(-1.96, 0.0).alias("low"), one(1.96, 100.0).alias("high"))


def elo_difference(w: Column, losses: Column, d: Column) -> Column:
    """With one decimal, between -800 and 800; NULL without games."""
    n = w + losses + d
    s = (w + 0.5 * d) / F.nullif(n, F.lit(0))
    return F.when(s <= 0, -800.0).when(s >= 1, 800.0).otherwise(F.round(-400.0 * F.log10(1.0 / F.when((s > 0) & (s < 1), s) - 1.0), 1))


def time_control_class(tc: Column) -> Column:
    """ultra_fast, bullet, blitz, rapid or classical of a control such as 60+0.6 or 1:30+1, by base + 40 increments."""
    tc = F.trim(tc)
    base, inc = F.split_part(tc, F.lit("+"), F.lit(1)), F.coalesce(F.split_part(tc, F.lit("+"), F.lit(2)).try_cast("double"), F.lit(0.0))
    clock = F.split(base, ":")
    seconds = F.when(F.size(clock) == 2, clock[0].try_cast("double") * 60 + F.get(clock, F.lit(1)).try_cast("double")).when(F.size(clock) > 2, clock[0].try_cast("double") * 60).otherwise(base.try_cast("double"))
    minutes = (seconds + 40 * inc) / 60.0
    return F.when(minutes < 0.25, "ultra_fast").when(minutes < 2, "bullet").when(minutes < 10, "blitz").when(minutes < 30, "rapid").when(minutes.isNotNull(), "classical")
