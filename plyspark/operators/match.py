"""Operators on matches, tournaments, test suites and tuning runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import elo
from ..functions.safe import ratio
from ..scratch import saved
from .order import ranked

K = 32.0


def correctness(rows: DataFrame) -> DataFrame:
    """Adds ``stored_correct`` (the first two expected moves count) and ``suite_correct`` (any does); without expected moves, any move but the avoided."""
    has, avoids = F.size("expected") > 0, F.size("avoid") > 0
    two = F.array_contains(F.slice("expected", 1, 2), F.col("move"))
    stored = F.when(has, two).when(avoids, F.col("move") != F.get("avoid", F.lit(0))).otherwise(False)
    suite = F.when(has, F.array_contains("expected", F.col("move"))).when(avoids, ~F.array_contains("avoid", F.col("move"))).otherwise(False)
    return rows.withColumns({"stored_correct": F.coalesce(stored, F.lit(False)), "suite_correct": F.coalesce(suite, F.lit(False))})


def phase_label(step: Column) -> Column:
    """Of a tuning run by the size of its steps."""
    return F.when(step > 0.1, "EXPLORING").when(step > 0.05, "TUNING").when(step > 0.01, "SETTLING").otherwise("CONVERGED")


def scaled(value: str, window: Window) -> Column:
    """0 to 1 within a window, one half where all are equal."""
    low, high = F.min(value).over(window), F.max(value).over(window)
    return F.when(high > low, (F.col(value) - low) / F.nullif(high - low, F.lit(0.0))).otherwise(0.5)


def aligned(rows: DataFrame, key: str, of: str, values: Sequence, metric: str) -> DataFrame:
    """One row for each key with a column for each of ``values``, NULL where it has no row."""
    return rows.groupBy(key).pivot(of, list(values)).agg(F.max(metric))


def first_and_last(rows: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The row of least key and the ``n`` of largest, each once."""
    return rows.orderBy(F.desc(key)).limit(n).union(rows.orderBy(key).limit(1)).distinct()


def against_baseline(rows: DataFrame, key: str, baseline: object, metric: str, dead_zone: float = 0.1) -> DataFrame:
    """Mean of a metric by key, its difference to the baseline's, in percent too, and the direction."""
    means = rows.groupBy(key).agg(F.avg(metric).alias("mean"))
    base = means.where(F.col(key) == F.lit(baseline)).select(F.col("mean").alias("base"), F.lit(1).alias("one"))
    joined = means.withColumn("one", F.lit(1)).join(F.broadcast(base), "one")
    percent = 100 * ratio(F.col("mean") - F.col("base"), "base")
    return joined.select(key, "mean", (F.col("mean") - F.col("base")).alias("delta"), percent.alias("percent"), F.when(percent > dead_zone, "up").when(percent < -dead_zone, "down").otherwise("same").alias("direction"))


def suite_accuracy(results: DataFrame) -> DataFrame:
    """Correct moves and mean score difference by category, and over all (category NULL)."""
    rows = results.withColumn("category", F.split("category", " - ")[0])
    return rows.rollup("category").agg(F.count("*").alias("n"), F.count_if("move_is_correct").alias("correct"), F.avg(F.abs(F.col("engine_score") - F.col("expected_score"))).alias("mean_difference"))


def game_pairs(games: DataFrame, run: str) -> DataFrame:
    """Counts of pairs of games (1 and 2, 3 and 4, ...) by their two outcomes in order; a pair with one game is left out."""
    pair = F.floor((F.col("game_num") - 1) / 2)
    pairs = games.groupBy(run, pair.alias("pair")).agg(F.concat_ws("", F.array_sort(F.collect_list("outcome"))).alias("kind"))
    return pairs.where(F.length("kind") == 2).groupBy(run, "kind").agg(F.count("*").alias("n"))


def pair_scores(games: DataFrame, run: str) -> DataFrame:
    points = F.when(F.col("kind") == "ww", 2.0).when(F.col("kind") == "dw", 1.5).when(F.col("kind").isin("lw", "dd"), 1.0).when(F.col("kind") == "dl", 0.5).otherwise(0.0)
    return game_pairs(games, run).groupBy(run).agg(F.sum("n").alias("pairs"), (F.sum(points * F.col("n")) / (2 * F.sum("n"))).alias("score"))


def running_test(games: DataFrame, run: str, elo0: float = 0.0, elo1: float = 10.0, alpha: float = 0.05, beta: float = 0.05) -> DataFrame:
    """After each game of a run: wins, draws and losses so far, the likelihood ratio and what it decides."""
    so_far = Window.partitionBy(run).orderBy("game_num")
    total = lambda o: F.sum(F.when(F.col("outcome") == o, 1).otherwise(0)).over(so_far)
    rows = games.withColumns({"wins": total("w"), "draws": total("d"), "losses": total("l")})
    llr = elo.log_likelihood_ratio(F.col("wins"), F.col("draws"), F.col("losses"), elo0, elo1)
    return rows.withColumn("llr", llr).withColumn("decision", elo.decision(F.col("llr"), *elo.bounds(alpha, beta)))


def decided(records: DataFrame, elo0: float = 0.0, elo1: float = 10.0, alpha: float = 0.05, beta: float = 0.05) -> DataFrame:
    llr = elo.log_likelihood_ratio(F.col("wins"), F.col("draws"), F.col("losses"), elo0, elo1)
    return records.select("engine_id", llr.alias("llr")).withColumn("decision", elo.decision(F.col("llr"), *elo.bounds(alpha, beta)))


def pool_rating(results: DataFrame, opponent: Column) -> DataFrame:
    """Rating against rated opponents: their rating plus the difference, weighed by games."""
    games = F.col("wins") + F.col("draws") + F.col("losses")
    estimates = results.where(games > 0).select((opponent + elo.elo_difference(F.col("wins"), F.col("losses"), F.col("draws"))).alias("r"), games.alias("n"))
    return estimates.agg(F.round(F.sum(F.col("r") * F.col("n")) / F.sum("n"), 1).alias("rating"), F.sum("n").alias("games"))


def pairwise(games: DataFrame) -> DataFrame:
    """(name, opponent, wins, draws, losses) in both directions from games (white, black, result '1-0', '0-1', '1/2-1/2')."""
    won = F.when(F.col("result") == "1-0", 1).when(F.col("result") == "0-1", -1).when(F.col("result") == "1/2-1/2", 0)
    sides = games.where(won.isNotNull()).select(F.explode(F.array(F.struct(F.col("white").alias("name"), F.col("black").alias("opponent"), won.alias("p")), F.struct(F.col("black").alias("name"), F.col("white").alias("opponent"), (-won).alias("p")))).alias("x")).select("x.*")
    of = lambda p, n: F.count_if(F.col("p") == p).alias(n)
    return sides.groupBy("name", "opponent").agg(of(1, "wins"), of(0, "draws"), of(-1, "losses"))


def paired_results(records: DataFrame) -> DataFrame:
    """Made-up neighbours for records of single engines: each against the next id."""
    return records.select(F.col("engine_id").alias("name"), (F.col("engine_id") + 1).alias("opponent"), "wins", "draws", "losses", (1500.0 + F.col("engine_id") % 100).alias("rating"), (1500.0 + (F.col("engine_id") + 1) % 100).alias("opponent_rating"))


def elo_deltas(results: DataFrame) -> DataFrame:
    """K * (actual - expected) of each pair for both sides, added up by engine."""
    games = F.col("wins") + F.col("draws") + F.col("losses")
    delta = K * (F.col("wins") + 0.5 * F.col("draws") - games * elo.elo_to_score(F.col("rating") - F.col("opponent_rating")))
    both = results.select(F.explode(F.array(F.struct("name", delta.alias("d")), F.struct(F.col("opponent").alias("name"), (-delta).alias("d")))).alias("x"))
    return both.groupBy("x.name").agg(F.sum("x.d").alias("delta"))


def performance_ratings(results: DataFrame) -> DataFrame:
    """(candidate, rating, games): the rating whose expected points equal the actual, by bisection; opponents' mean plus or minus 800 for all or no points.

    Opponents are first added up by rating, so a group has a row for each distinct rating.
    """
    games = F.col("wins") + F.col("draws") + F.col("losses")
    sums = results.where(games > 0).groupBy("candidate", "opponent_elo").agg(F.sum(games).cast("double").alias("n"), F.sum(F.col("wins") + 0.5 * F.col("draws")).cast("double").alias("points"))
    rows = sums.groupBy("candidate").agg(
        F.sum("n").alias("games"), F.sum("points").alias("points"), (F.sum(F.col("opponent_elo") * F.col("n")) / F.sum("n")).alias("mean"),
        F.array_sort(F.collect_list(F.struct(F.col("opponent_elo").cast("double").alias("elo"), "n"))).alias("met"),
    )
    points = "aggregate(met, 0D, (sum, o) -> sum + o.n / (1 + pow(10D, (o.elo - {at}) / 400)))"
    middle = "(bounds.low + bounds.high) / 2"
    solved = f"""aggregate(sequence(1, 100), struct(-1000D AS low, 5000D AS high), (bounds, step) -> CASE WHEN {points.format(at=f"({middle})")} < points
        THEN struct({middle} AS low, bounds.high AS high) ELSE struct(bounds.low AS low, {middle} AS high) END, bounds -> {middle})"""
    rating = F.when(F.col("points") >= F.col("games"), F.col("mean") + 800).when(F.col("points") <= 0, F.col("mean") - 800).otherwise(F.expr(solved))
    return rows.select(F.col("candidate").cast("long").alias("candidate"), F.round(rating, 1).alias("rating"), F.col("games").cast("long").alias("games"))


def looked_up(engines: DataFrame, ratings: DataFrame, default: float = elo.ANCHOR) -> DataFrame:
    return engines.join(ratings, F.col("id") == F.col("engine_id"), "left").select("id", F.coalesce("elo", F.lit(default)).alias("elo"))


def paired_summary(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Count, mean and standard deviation of differences, pairs with a NULL or NaN left out, and Cohen's d (0 without spread)."""
    d = F.nanvl(F.col(a) - F.col(b), F.lit(None).cast("double"))
    out = rows.agg(F.count(d).alias("n"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("sd"))
    return out.withColumn("cohen_d", F.coalesce(ratio("mean", "sd"), F.lit(0.0)))


def effective_branching(iterations: DataFrame) -> DataFrame:
    """Time so far and the root of growth over two depths; a search's last depth, which may be cut short, is left out."""
    by_depth = Window.partitionBy("search_id").orderBy("depth")
    rows = iterations.withColumns({
        "cumulative_ms": F.sum("time_ms").over(by_depth), "ebf2": F.sqrt(ratio("total_nodes", F.lag("total_nodes", 2).over(by_depth))),
        "left": F.row_number().over(Window.partitionBy("search_id").orderBy(F.desc("depth"))),
    })
    return rows.where("left > 1").select("search_id", "depth", "cumulative_ms", "ebf2")


def trailing(iterations: DataFrame, n: int = 20) -> DataFrame:
    by_depth = Window.partitionBy("search_id").orderBy("depth")
    win = F.when(F.col("nodes") > F.col("qnodes"), 1.0).otherwise(0.0)
    return iterations.select("search_id", "depth", F.avg("time_ms").over(by_depth.rowsBetween(1 - n, 0)).alias("trailing"), F.avg(win).over(by_depth.rowsBetween(Window.unboundedPreceding, 0)).alias("win_rate"))


def smoothed(rows: DataFrame, key: str, order: str, metric: str, alpha: float = 0.2) -> DataFrame:
    """(key, order, ema): exponential moving average by key, from the first value on; rows without a value are left out.

    Each step is x -> (1 - alpha) x + alpha v, so an average is a running composition of such maps (``composed``).
    """
    part = rows.select(F.col(key).cast("long").alias(key), F.col(order).cast("long").alias(order), F.col(metric).cast("double").alias("ema")).where("ema IS NOT NULL")
    numbered = ranked(part, [key, order, "ema"], name="at")
    first = numbered.groupBy(F.col(key).alias("of")).agg(F.min("at").alias("first"))
    steps = numbered.join(first, F.col(key).eqNullSafe(F.col("of"))).withColumn("place", F.col("at") - F.col("first"))
    begins = F.col("place") == 0
    steps = steps.select(key, order, "place", F.when(begins, 0.0).otherwise(1 - alpha).alias("factor"), F.when(begins, F.col("ema")).otherwise(alpha * F.col("ema")).alias("term"))
    return composed(steps, key).select(key, order, F.col("value").alias("ema"))


def composed(steps: DataFrame, key: str, block: int = 64) -> DataFrame:
    """``steps`` with ``value``: the maps x -> factor * x + term of a key, in order of ``place`` (0, 1, ...), all up to each row's applied to 0.

    Places are cut into blocks; a block's maps make one map, and these are composed alike, so no task holds more than
    ``block`` rows of a key at once, and each level has a ``block``-th of the rows of the one below.
    """
    rest = [c for c in steps.columns if c not in (key, "place", "factor", "term")]
    grouped = steps.groupBy(key, F.floor(F.col("place") / block).alias("block")).agg(F.array_sort(F.collect_list(F.struct("place", "factor", "term", *rest))).alias("rows"))
    grouped = grouped.withColumn("upto", F.expr("""aggregate(rows, cast(array() AS array<struct<f: double, t: double>>), (done, r) -> concat(done, array(CASE WHEN size(done) = 0
        THEN struct(r.factor AS f, r.term AS t) ELSE struct(element_at(done, -1).f * r.factor AS f, element_at(done, -1).t * r.factor + r.term AS t) END)))"""))
    grouped = saved(grouped, "composed")
    values = grouped.select(key, "block", F.explode(F.arrays_zip("rows", "upto")).alias("z"))
    carry = F.lit(0.0)
    if (grouped.agg(F.max("block")).first()[0] or 0) > 0:
        whole = grouped.select(key, F.col("block").alias("place"), F.element_at("upto", -1).alias("m")).select(key, "place", F.col("m.f").alias("factor"), F.col("m.t").alias("term"))
        before = composed(whole, key, block).select(F.col(key).alias("of"), (F.col("place") + 1).alias("next"), F.col("value").alias("carry"))
        values = values.join(before, F.col(key).eqNullSafe(F.col("of")) & (F.col("block") == F.col("next")), "left")
        carry = F.coalesce("carry", F.lit(0.0))
    return values.select(key, *[F.col(f"z.rows.{c}").alias(c) for c in ("place", "factor", "term", *rest)], (F.col("z.upto.f") * carry + F.col("z.upto.t")).alias("value"))
