"""The warehouse: raw tables to analytics tables, whole or incrementally, each load one version of a store."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.safe import decoded, last_part, trimmed_part
from ..operators.order import ranked
from ..operators.search import iteration_features, tree_features, wide_features
from ..schemas import FEATURES, OPTIONAL, REQUIRED
from ..sources.positions import classified
from . import store as versions
from .store import upsert

__all__ = ["Migration", "Store", "build_features", "contract", "derived", "imported", "load", "migrate", "registered", "upsert"]

#: Codes of the logs.
RESULTS = {1: "white", 2: "black", 3: "draw"}
TERMINATIONS = {1: "checkmate", 2: "stalemate", 3: "threefold", 4: "fiftymove", 5: "time", 6: "resign"}
#: Keys of analytics tables.
KEYS = {
    "engines": ("id",), "experiments": ("id",), "engine_ratings": ("id",), "sprt_runs": ("id",), "sts_runs": ("id",), "game_stats": ("id",), "search_stats": ("id",), "dim_positions": ("search_id",),
    "iterative_deepening_stats": ("search_id", "depth"), "search_tree_stats": ("search_id", "depth"), "search_timings": ("search_id", "function"), "root_moves": ("search_id", "depth", "move"),
    "search_iteration_features": ("search_id", "depth"), "search_tree_features": ("search_id", "depth"), "search_features": ("search_id",), "position_features": ("search_id",),
}
TRUTH = {"sf_eval": "int", "sf_best_move": "string", "sf_time_ms": "double", "sf_computed_at": "timestamp", "sf_pv": "string", "eval_diff": "double"}


class Store(versions.Store):
    """A store whose analytics tables have their keys."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, KEYS)


def imported(to: Store, url: str, tables: dict[str, str | None], parts: int = 8, **options: str) -> None:
    """Copies ``tables`` of a database (JDBC ``url``; its driver on Spark's class path) into a store.

    A table with a numeric key is read in ``parts`` ranges of it, at once; one without (None), or without rows, in one. ``options`` go to the source.
    """
    for table, key in tables.items():
        source = to.spark.read.format("jdbc").options(url=url, **options)
        df = source.option("dbtable", table).load()
        bounds = df.agg(F.min(key), F.max(key)).first() if key else (None, None)
        if bounds[0] is not None:
            ranges = {"partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)}
            df = source.options(dbtable=table, **ranges).load()
        to.write(table, df)


def registered(engines: DataFrame, new: DataFrame) -> DataFrame:
    """``engines`` and those of ``new`` whose version it doesn't have, with ids that follow."""
    last = engines.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = ranked(new.join(engines.select("version"), "version", "left_anti").drop("id"), ["version"], last)
    return engines.unionByName(fresh, allowMissingColumns=True)


# raw to analytics


def _game_stats(games: DataFrame, book: DataFrame | None) -> DataFrame:
    named = classified(games.drop("opening"), book) if book is not None else games.withColumns({"opening": F.coalesce("opening", F.lit("")), "opening_eco": F.lit("")})
    return named.withColumns({"result": decoded("result", RESULTS), "termination": decoded("termination", TERMINATIONS)})


def _sprt_runs(sprt: DataFrame) -> DataFrame:
    runs = sprt.withColumn("measured_elo_diff", F.col("elo_diff")) if "elo_diff" in sprt.columns else sprt
    return runs.withColumns({"alpha": F.col("alpha").cast("double"), "beta": F.col("beta").cast("double"), "opening_book": last_part("opening_book"), "elo_diff": (F.coalesce("elo1", F.lit(0)) - F.coalesce("elo0", F.lit(0))).cast("double")})


def _ratings(raw: Store) -> DataFrame:
    ratings, e = raw.read("engine_ratings"), raw.read("engines").select(F.col("id").alias("_e"), F.col("name").alias("engine_name"), F.col("version").alias("engine_version"))
    return ratings.join(e, F.col("engine_id") == F.col("_e"), "left").drop("_e").withColumns({c: F.bround(c).cast("int") for c in ratings.columns if c.startswith("elo_")})


def derived(raw: Store, book: DataFrame | None = None) -> dict[str, tuple[str, str]]:
    """Analytics tables: name -> (raw table, key that grows)."""
    return {
        "engines": ("engines", "id"), "experiments": ("experiments", "id"), "engine_ratings": ("engine_ratings", "id"), "sprt_runs": ("sprt", "id"), "sts_runs": ("sts", "id"), "game_stats": ("games", "id"), "search_stats": ("searches", "id"),
        "iterative_deepening_stats": ("searches_by_iteration", "search_id"), "search_tree_stats": ("searches_by_tree_depth", "search_id"), "search_timings": ("timing", "search_id"), "root_moves": ("root_moves", "search_id"), "dim_positions": ("searches", "id"),
    }


def _shaped(table: str, rows: DataFrame, raw: Store, book: DataFrame | None) -> DataFrame:
    if table == "engine_ratings":
        return _ratings(raw).join(rows.select("id"), "id", "left_semi")
    if table == "sprt_runs":
        return _sprt_runs(rows)
    if table == "sts_runs":
        return rows.withColumns({"suite": last_part("suite"), "position_type": trimmed_part("position_name", "-", 2)})
    if table == "game_stats":
        return _game_stats(rows, book)
    if table == "search_stats":
        return rows.withColumns({c: F.lit(None).cast(t) for c, t in TRUTH.items()})
    if table == "dim_positions":
        return rows.select(F.col("id").alias("search_id"), "fen", "game_id", "sts_id")
    return rows


def load(raw: Store, to: Store, full: bool = False, book: DataFrame | None = None, late: bool = False) -> dict[str, int]:
    """Loads every table that ``raw`` has, in one commit; the last id of each before.

    Incrementally, rows over the last id loaded are appended; with ``late``, rows whose whole key isn't loaded, which also finds
    ids and children of loaded searches that came late. Of a raw table that has only grown, just the parts that no load has taken are
    looked through; a key is looked up only in files that can hold it.
    """
    marks, seen = {}, raw.at(raw.version)
    with to.begin() as commit:
        for table, (source, key) in derived(raw).items():
            if not seen.exists(source):
                continue
            rows, taken = seen.read(source), {source: seen.parts(source)}
            loaded = "search_id" if table == "dim_positions" else key
            marks[table] = 0 if full else commit.last_id(table, loaded)
            if full or not commit.exists(table):
                commit.write(table, _shaped(table, rows, raw, book), taken)
                continue
            if late:
                grown = seen.added(source, commit.taken(table))
                names = {k: "id" for k in KEYS[table]} if table == "dim_positions" else {}
                new = commit.missing(table, rows if grown is None else grown, names)
            else:
                new = rows.where(F.col(key) > marks[table])
            if not new.isEmpty():
                commit.append(table, _shaped(table, new, raw, book), taken)
    return marks


def build_features(to: Store, full: bool = False) -> dict[str, int]:
    """The feature tables in one commit; of each the files replaced.

    What a search's features are made from may grow late. So the searches that parts taken since the last build name are built anew, and
    merged into the files that hold them; a table is built whole the first time, with ``full``, or where a source was replaced.
    """
    replaced = {}
    with to.begin() as commit:

        def built(name: str, sources: dict[str, str], make: Callable[[Callable[[str], DataFrame]], DataFrame]) -> None:
            taken = {s: commit.parts(s) for s in sources}
            before = commit.taken(name)
            grown = {s: commit.added(s, before) for s in sources} if commit.exists(name) and not full else {}
            if not grown or any(df is None for df in grown.values()):
                commit.write(name, make(commit.read), taken)
                replaced[name] = 0
                return
            ids = reduce(DataFrame.unionAll, [df.select(F.col(sources[s]).cast("long").alias("_changed")) for s, df in grown.items()]).distinct()
            if not ids.isEmpty():
                of = lambda t: commit.read(t).join(ids, F.col(sources[t]) == F.col("_changed"), "left_semi") if t in sources else commit.read(t)
                replaced[name] = commit.merge(name, make(of), taken=taken)

        built("search_tree_features", {"search_tree_stats": "search_id"}, lambda of: tree_features(of("search_tree_stats")))
        built("search_iteration_features", {"iterative_deepening_stats": "search_id"}, lambda of: iteration_features(of("iterative_deepening_stats")))
        wide = {"search_stats": "id", "iterative_deepening_stats": "search_id", "search_timings": "search_id", "position_features": "search_id"}
        built("search_features", wide, lambda of: wide_features(of("search_stats"), iteration_features(of("iterative_deepening_stats")), of("search_timings"), of("position_features"), of("engines"), of("game_stats"), of("sts_runs")))
        differing = commit.read("search_stats").where("eval_diff IS NULL AND eval IS NOT NULL AND sf_eval IS NOT NULL")
        if not differing.isEmpty():
            replaced["search_stats"] = commit.merge("search_stats", differing.select("id", (F.col("eval") - F.col("sf_eval")).cast("double").alias("eval_diff")))
    return replaced


# migrations and contracts


@dataclass(frozen=True)
class Migration:
    """Columns (name, type, default) that a table gains."""

    id: str
    table: str
    columns: tuple[tuple[str, str, object], ...] = field(default_factory=tuple)


def migrate(store: Store, migrations: list[Migration], only: str | None = None, dry_run: bool = False) -> list[str]:
    """Applies those that the ledger hasn't, in order; the ids applied (or that would be). Columns that exist stay."""
    done = {r.id for r in store.read("schema_migrations").collect()} if store.exists("schema_migrations") else set()
    applied = []
    for m in migrations:
        if m.id in done or (only and m.id != only):
            continue
        applied.append(m.id)
        if dry_run or not store.exists(m.table):
            continue
        with store.begin() as commit:
            df = commit.read(m.table)
            commit.write(m.table, df.withColumns({n: F.lit(v).cast(t) for n, t, v in m.columns if n not in df.columns}))
            commit.append("schema_migrations", store.spark.createDataFrame([(m.id,)], "id string").withColumn("applied_at", F.current_timestamp()))
    return applied


def contract(store: Store) -> DataFrame:
    """(severity, message) of tables and columns that reports need and the store lacks."""
    found: list[tuple[str, str]] = []
    for kind, tables, absent, lacking in (("required", REQUIRED, "error", "error"), ("feature", FEATURES, "warn", "error"), ("optional", OPTIONAL, "warn", "warn")):
        for table, columns in tables.items():
            have = store.columns(table)
            if not have:
                found.append((absent, f"{kind} table {table} is missing"))
            found += [(lacking, f"{table}.{c} is missing") for c in columns.split() if have and c not in have]
    if store.exists("search_stats") and store.read("search_stats").isEmpty():
        found.append(("warn", "search_stats is empty"))
    return store.spark.createDataFrame(found, "severity string, message string")
