"""Text reports: match runners' output, engines' statistics, and option listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, line): the lines of files of any size, split among tasks; ``at`` puts a file's lines in order."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), place.alias("at"), F.trim(F.rtrim("value", F.lit("\r"))).alias("line"))


def label_values(text: Column) -> Column:
    """Array of (label, value) of a report: each number, whole or decimal, with or without a percent sign, under the words of its line since the number before.

    Numbers without words before them have no label and are left out.
    """
    start = F.struct(F.lit("").alias("label"), F.array().cast("array<struct<label: string, value: double>>").alias("found"))

    def read(state: Column, word: Column) -> Column:
        value = F.when(word.rlike(r"^\d+(\.\d+)?%?$"), F.rtrim(word, F.lit("%")).try_cast("double"))
        named = value.isNotNull() & (state["label"] != "")
        label = F.when(value.isNotNull(), F.lit("")).when(state["label"] == "", word).otherwise(F.concat(state["label"], F.lit(" "), word))
        pair = F.struct(state["label"].alias("label"), value.alias("value"))
        return F.struct(label.alias("label"), F.when(named, F.array_append(state["found"], pair)).otherwise(state["found"]).alias("found"))

    words = lambda line: F.filter(F.split(line, r"\s+"), lambda w: w != "")
    return F.flatten(F.transform(F.split(text, r"\r?\n"), lambda line: F.aggregate(words(line), start, read, lambda state: state["found"])))


def labelled(pairs: Column, label: str) -> Column:
    """The first value in ``label_values`` whose label is ``label`` or ends with it; NULL where none is."""
    own = F.filter(pairs, lambda x: (x["label"] == label) | x["label"].endswith(" " + label))
    return F.get(own, F.lit(0))["value"]


def statistics(reports: DataFrame) -> DataFrame:
    """``reports`` (text) with the labelled numbers of each as ``statistics`` and the percentage of quiescence nodes, ``q_ratio``."""
    found = reports.withColumn("statistics", label_values(F.col("text")))
    nodes, quiet = labelled(F.col("statistics"), "Total"), labelled(F.col("statistics"), "QNodes")
    return found.withColumn("q_ratio", F.when(nodes > 0, 100.0 * quiet / nodes))


def depth_table(lines: DataFrame) -> DataFrame:
    """(file, depth, eval, time, nodes) of the per-depth table, without the last depth, which may be cut short."""
    fields = F.split("line", r"\s+")
    rows = lines.withColumn("f", fields)
    header = rows.where(F.startswith("line", F.lit("D  Eval"))).groupBy("file").agg(F.min("at").alias("from"))
    number = lambda k: F.get("f", F.lit(k)).try_cast("long")
    body = rows.join(header, "file").where((F.col("at") > F.col("from")) & (F.size("f") >= 5) & F.get("f", F.lit(0)).rlike(r"^\d+$"))
    table = body.select("file", number(0).alias("depth"), number(1).alias("eval"), number(3).alias("time"), number(4).alias("nodes"))
    last = table.groupBy("file").agg(F.max("depth").alias("last"))
    return table.join(last, "file").where("depth < last").drop("last")


def finite(text: Column) -> Column:
    """Double; NULL for nan and inf."""
    return F.when(text.rlike(r"^[+-]?\d+(\.\d+)?$"), text.try_cast("double"))


def _after(line: Column, label: str) -> Column:
    """What follows the first ``label`` in a line; NULL without it."""
    at = F.instr(line, F.lit(label))
    return F.when(at > 0, F.substring(line, at + F.lit(len(label)), F.length(line)))


def _field(record: Column, label: str) -> Column:
    """The first word of the value of ``label`` in a record of "label value" or "label: value" fields between commas."""
    fields = F.transform(F.split(record, ","), lambda x: F.split(F.trim(F.replace(x, F.lit(":"), F.lit(" "))), " +"))
    return F.get(F.get(F.filter(fields, lambda words: F.get(words, F.lit(0)) == label), F.lit(0)), F.lit(1))


def _score(text: Column) -> Column:
    """Wins, losses and draws of text that begins "wins - losses - draws", as an array; NULL where these aren't three numbers."""
    numbers = F.transform(F.slice(F.split(F.trim(text), "-"), 1, 3), lambda x: F.get(F.split(F.trim(x), " "), F.lit(0)).try_cast("long"))
    return F.when((F.size(numbers) == 3) & ~F.exists(numbers, F.isnull), numbers)


def match_report(lines: DataFrame, candidate: str = "Candidate") -> DataFrame:
    """One row for each file: the last score in all and by colour, rating, and test lines, and what the test says. Scores are wins - losses - draws."""
    line, low = F.col("line"), F.lower("line")
    by_colour = lambda colour: _score(_after(line, f"{candidate} playing {colour}:"))
    elo, test = _after(low, "elo difference:"), _after(low, "sprt:")
    found = {
        "score": _score(F.when(F.contains(line, F.lit(f"Score of {candidate} vs ")), F.element_at(F.split(line, ":"), -1))),
        "white": by_colour("White"), "black": by_colour("Black"),
        "elo": F.when(elo.isNotNull(), F.array(F.get(F.split(F.trim(elo), " "), F.lit(0)), _field(elo, "los"), _field(elo, "drawratio"))),
        "sprt": F.when(test.isNotNull(), F.array(*[_field(test, k) for k in ("llr", "lbound", "ubound")])),
    }
    rows = lines.withColumns(found)
    last = rows.groupBy("file").agg(*[F.max_by(k, F.when(F.col(k).isNotNull(), F.col("at"))).alias(k) for k in found])
    whole = lambda k, i: F.coalesce(F.get(k, F.lit(i)), F.lit(0).cast("long"))
    columns = {f"candidate{'' if k == 'score' else '_' + k}_{n}": whole(k, i) for k in ("score", "white", "black") for i, n in enumerate(("wins", "losses", "draws"))}
    columns |= {n: finite(F.get("elo", F.lit(i))) for i, n in enumerate(("elo_diff", "los", "draw_ratio"))} | {n: finite(F.get("sprt", F.lit(i))) for i, n in enumerate(("llr", "lbound", "ubound"))}
    out = last.select("file", *[v.alias(k) for k, v in columns.items()])
    games = F.col("candidate_wins") + F.col("candidate_losses") + F.col("candidate_draws")
    return out.withColumn("games_played", games).withColumn("result", F.when(F.col("llr") > F.col("ubound"), "pass").when(F.col("llr") < F.col("lbound"), "fail").when(F.col("llr").isNotNull(), "inconclusive"))


def finished_games(lines: DataFrame) -> DataFrame:
    """(file, at, white, black, result) of finished games, in order: players stand between brackets, the result between them and a remark in braces."""
    told = _after(F.col("line"), "Finished game ")
    players, rest = F.substring_index(_after(told, " ("), "): ", 1), _after(told, "): ")
    names = F.split(players, " vs ", 2)
    result = F.replace(F.substring_index(rest, "{", 1), F.lit(" "), F.lit(""))
    games = lines.select("file", "at", F.trim(F.get(names, F.lit(0))).alias("white"), F.trim(F.get(names, F.lit(1))).alias("black"), result.alias("result"))
    return games.where(F.col("black").isNotNull() & F.col("result").isin("1-0", "0-1", "1/2-1/2"))


def options(lines: DataFrame) -> DataFrame:
    """(name, type, default, min, max) of 'option name ...' lines: a name of any words, then words each before its value."""
    told = F.split(_after(F.col("line"), "option name "), " type ", 2)
    parts = F.split(F.get(told, F.lit(1)), " (?=(?:default|min|max|var) )")
    value = lambda k: F.nullif(_after(F.get(F.filter(parts, lambda x: F.startswith(x, F.lit(f"{k} "))), F.lit(0)), f"{k} "), F.lit(""))
    kind = F.get(F.split(F.get(parts, F.lit(0)), " "), F.lit(0))
    known = lines.where(F.startswith("line", F.lit("option name ")) & kind.isNotNull())
    return known.select(F.get(told, F.lit(0)).alias("name"), kind.alias("type"), F.trim(value("default"), F.lit('"')).alias("default"), value("min").alias("min"), value("max").alias("max"))


def option_value(defaults: Column, key: str, kind: str = "int", scale: float = 1.0) -> Column:
    """A default from a map of options under any spelling of its name, as int, double or boolean."""
    spellings = dict.fromkeys([key, key.lower(), key.upper(), key.replace("_", " "), key.replace("_", " ").lower(), key.replace("_", " ").title()])
    raw = F.coalesce(*[F.try_element_at(defaults, F.lit(s)) for s in spellings])
    if kind == "boolean":
        return F.lower(raw).isin("1", "true", "yes", "on")
    return raw.try_cast("double").cast("int") if kind == "int" else raw.try_cast("double") / scale


def option_text(name: Column, value: Column, low: Column, high: Column, whole: Column) -> Column:
    """'option.name=value' with the value rounded where ``whole``, within its bounds."""
    v = F.least(F.greatest(F.when(whole, F.bround(value)).otherwise(value), low), high)
    return F.concat(F.lit("option."), name, F.lit("="), F.when(whole, v.cast("long").cast("string")).otherwise(v.cast("string")))
