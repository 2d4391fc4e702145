"""Position suites (EPD), opening books (PGN), move lists and position files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.positions import uci_prefix
from ..scratch import saved


def epd(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, fen, id, ce, c0, expected, avoid) of every record; blank lines, comments and lines of under four fields are left out."""
    lines = spark.read.text(paths, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("line"))
    parts = F.split("line", ";")
    fields = F.split(F.trim(parts[0]), r"\s+")
    rows = lines.where(~F.startswith("line", F.lit("#"))).withColumns({"_p": parts, "_f": fields}).where(F.size("_f") >= 4)

    def after(op: str) -> Column:
        at = F.array_position("_f", op).cast("int")
        return F.when(at > 0, F.slice("_f", at + 1, F.greatest(F.lit(0), F.size("_f") - at))).otherwise(F.array().cast("array<string>"))

    def operand(op: str) -> Column:
        return F.get(F.filter(F.transform(F.slice("_p", 2, F.size("_p")), lambda x: F.trim(x)), lambda x: x.startswith(op)), F.lit(0))

    text = lambda op: F.trim(F.regexp_extract(operand(op), r"^\S+\s(.*)$", 1), F.lit('" '))
    return rows.select(
        "file", F.concat(F.array_join(F.slice("_f", 1, 4), " "), F.lit(" 0 1")).alias("fen"), F.when(operand("id").isNotNull(), text("id")).alias("id"), F.get(F.split(operand("ce"), r"\s+"), F.lit(1)).try_cast("int").alias("ce"),
        F.when(operand("c0").isNotNull(), text("c0")).alias("c0"), after("bm").alias("expected"), after("am").alias("avoid"),
    )


def pgn_openings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(at, eco, name, moves): tags and moves in UCI of each game of a book; moves end at the first that isn't legal.

    A file is read in pieces, split where a game's first tag stands, so no row holds a whole book. A piece that began within a remark in
    braces, or not at the beginning of a line, is joined to the one before it again: which brace was the last is told by a window over
    the pieces of a file. ``at`` puts games in order of file and place. Moves are read once for each distinct list, lists in order, so
    once for each distinct prefix but for those that tasks share.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    pieces = spark.read.text(paths, lineSep="[ECO ").select(F.col("_metadata.file_path").alias("file"), place.alias("place"), "value")
    in_file = Window.partitionBy("file").orderBy("place")
    brace = F.nullif(F.regexp_extract("value", r"([{}])[^{}]*$", 1), F.lit(""))
    open_before = F.coalesce(F.last(brace, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)) == "{", F.lit(False))
    at_line = F.lag("value").over(in_file).rlike(r"(^|\n)$")
    pieces = pieces.withColumns({"begins": ~open_before & F.coalesce(at_line, F.lit(False))})
    pieces = pieces.withColumn("game", F.count_if("begins").over(in_file)).where("game > 0")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "[ECO ")
    games = pieces.groupBy("file", "game").agg(F.min("place").alias("place"), joined.alias("value"))
    games = games.select(F.struct("file", "place").alias("at"), F.regexp_replace("value", r"\{[^}]*(\}|$)", " ").alias("g")).where(F.startswith("g", F.lit('"')))
    tag = lambda name: F.regexp_extract("g", rf'\[{name} "([^"]*)"\]', 1)
    body = F.regexp_replace(F.regexp_replace("g", r'^"[^"]*"\]', " "), r"\[[^\]]*\]", " ")
    moves = F.trim(F.regexp_replace(body, r"\d+\.+|\*|1-0|0-1|1/2-1/2|\$\d+", " "))
    tokens = F.filter(F.split(moves, r"\s+"), lambda x: x != "")
    name = F.coalesce(F.nullif(tag("Opening"), F.lit("")), F.nullif(tag("Event"), F.lit("")), tag("Site"))
    read = saved(games.select("at", F.regexp_extract("g", r'^"([^"]*)"', 1).alias("eco"), name.alias("name"), tokens.alias("tokens")), "book")
    lists = read.select("tokens").distinct().repartitionByRange(spark.sparkContext.defaultParallelism, "tokens").sortWithinPartitions("tokens")
    lists = saved(lists.select("tokens", uci_prefix("tokens").alias("moves")), "lists")
    return read.join(lists, "tokens").select("at", "eco", "name", "moves")


def move_tokens(moves: Column) -> Column:
    """Of a move list as JSON array or text with spaces; none for NULL."""
    listed = F.from_json(F.when(F.trim(moves).startswith("["), moves), "array<string>")
    plain = F.filter(F.split(F.trim(moves), r"\s+"), lambda x: x != "")
    return F.coalesce(listed, plain, F.array().cast("array<string>"))


def prefix_hashes(moves: Column, most: int) -> Column:
    """A hash of the first 1, 2, ... moves of a list, up to ``most``: each from the one before and the next move."""
    start = F.struct(F.lit(0).cast("long").alias("h"), F.array().cast("array<bigint>").alias("all"))

    def further(state: Column, move: Column) -> Column:
        h = F.xxhash64(state["h"], move)
        return F.struct(h.alias("h"), F.array_append(state["all"], h).alias("all"))

    return F.aggregate(F.slice(moves, 1, most), start, further, lambda state: state["all"])


def classified(games: DataFrame, *books: DataFrame) -> DataFrame:
    """``games`` (id, moves) with the deepest opening of the ``books`` that their moves begin with, '' where none.

    A line of a book is found by the hash of all its moves among the hashes of a game's prefixes, which are numbers, one for each move up to
    the longest line; what is found is compared move by move, so equal hashes of other lines do no harm. Of equal lines the last of the last book counts.
    """
    numbered = [b.where(F.size("moves") > 0).select(F.struct(F.lit(k).alias("book"), "at").alias("at"), "eco", "name", "moves") for k, b in enumerate(books)]
    lines = reduce(DataFrame.unionAll, numbered).groupBy(F.col("moves").alias("line")).agg(F.max_by(F.struct("eco", "name"), "at").alias("entry"))
    longest = lines.agg(F.max(F.size("line"))).first()[0] or 0
    if not longest:
        return games.select("*", F.lit("").alias("opening"), F.lit("").alias("opening_eco"))
    entries = lines.select(F.element_at(prefix_hashes(F.col("line"), longest), -1).alias("h"), "line", "entry")
    lists = games.select("moves").distinct().withColumns({"uci": uci_prefix(move_tokens(F.col("moves"))), "list": F.xxhash64("moves")})
    # a condition on moves read would be pushed below the distinct, to every game: so it stands after they are saved
    lists = saved(lists, "lists").where(F.size("uci") > 0)
    prefixes = lists.select("list", F.explode(prefix_hashes(F.col("uci"), longest)).alias("h"))
    hits = prefixes.join(entries, "h").groupBy("list").agg(F.sort_array(F.collect_set(F.struct(F.size("line").alias("n"), "line", "entry")), asc=False).alias("hits"))
    deepest = F.get(F.filter("hits", lambda x: F.slice("uci", 1, x["n"]) == x["line"]), F.lit(0))
    found = lists.join(hits, "list").select(F.col("moves").alias("_m"), deepest["entry"].alias("e"))
    joined = games.join(found, F.col("moves").eqNullSafe(F.col("_m")), "left")
    return joined.select(*games.columns, F.coalesce("e.name", F.lit("")).alias("opening"), F.coalesce("e.eco", F.lit("")).alias("opening_eco"))


def named_positions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(fen, name) of lines 'fen | name'; without a name, the first 40 characters."""
    lines = spark.read.text(paths).select(F.trim("value").alias("v")).where("v <> '' AND NOT startswith(v, '#')")
    fen = F.trim(F.split_part("v", F.lit("|"), F.lit(1)))
    return lines.select(fen.alias("fen"), F.coalesce(F.nullif(F.trim(F.split_part("v", F.lit("|"), F.lit(2))), F.lit("")), F.substring(fen, 1, 40)).alias("name"))


def perft_positions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(F.trim(F.split_part("value", F.lit(";"), F.lit(1))).alias("fen")).where("fen <> ''")
