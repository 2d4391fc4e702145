"""Frontiers of positions, sequential tests over streams, intake of files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plyspark.chesscore.rules import START, Position
from plyspark.operators import frontier, match
from plyspark.plans.store import Store
from plyspark.schemas import struct
from plyspark.sources import intake
from plyspark.sources.intake import Taken
from plyspark.streaming import sequential
from pyspark.sql import types as T

KIWI = "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1"


# frontiers


def test_frontiers_of_known_positions(spark):
    asked = [(START, 4), (KIWI, 3), ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 41", 4), (START, 0), (START, 1), (None, 2), ("nonsense", 2), (START, None), (START, 4), ("7k/5Q2/6K1/8/8/8/8/8 b - - 0 1", 3)]
    rows = spark.createDataFrame(asked, "fen string, depth int")
    by = {(r.fen, r.depth): r.nodes for r in frontier.perft(rows).collect()}
    assert by[START, 4] == 197_281 and by[KIWI, 3] == 97_862 and by["8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 41", 4] == 43_238
    assert (by[START, 0], by[START, 1], by[None, 2], by["nonsense", 2], by[START, None]) == (1, 20, None, None, None)


def test_deep_frontiers_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(frontier, "TASK_POSITIONS", 300)
    rows = spark.createDataFrame([(START, 5), (KIWI, 4)], "fen string, depth int")
    assert {r.fen: r.nodes for r in frontier.perft(rows).collect()} == {START: 4_865_609, KIWI: 4_085_603}


def test_keys_are_read_back():
    rng = random.Random(1)
    for _ in range(40):
        p = Position(rng.choice([START, KIWI]))
        for _ in range(30):
            q = Position.of_key(p.key())
            assert q.key() == p.key() and sorted(q.legal_moves()) == sorted(p.legal_moves())
            if not (moves := p.legal_moves()):
                break
            p = p.play(rng.choice(moves))


# sequential tests


@pytest.fixture
def rocks(spark):
    # a query with timers asks for batches without end, so one that shall stop when its input is read does without empty ones
    settings = {"spark.sql.streaming.stateStore.providerClass": sequential.PROVIDER, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def played(spark, seed=3):
    rng, rows = random.Random(seed), []
    for run, chances in (("strong", "wwwd"), ("weak", "llld"), ("even", "wdld")):
        rows += [(run, k, rng.choice(chances)) for k in range(1, 241)]
    return rows


def run_stream(spark, tmp_path, batches, **options):
    folder = tmp_path / "games"
    folder.mkdir()
    stream = spark.readStream.schema("run string, game_num long, outcome string").option("maxFilesPerTrigger", 1).parquet(str(folder))
    for k, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "run string, game_num long, outcome string").coalesce(1)
        frame.write.mode("append").parquet(str(folder))
        query = sequential.sequential_tests(stream, **options).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        assert query.awaitTermination(60), query.stop()
        yield spark.read.schema(sequential.ROWS).parquet(str(tmp_path / "out"))


def test_out_of_order_games_equal_the_running_test(spark, tmp_path, rocks):
    rows = played(spark)
    mixed = random.Random(1).sample(rows, len(rows)) + rows[:30] + [("even", 9, "?"), ("even", 0, "w")]
    (*_, out) = run_stream(spark, tmp_path, [mixed[:200], mixed[200:500], mixed[500:]])
    whole = match.running_test(spark.createDataFrame(rows, "run string, game_num long, outcome string"), "run")
    first = whole.where("decision <> 'inconclusive'").groupBy("run").agg(F.min("game_num").alias("last"))
    want = whole.join(first, "run", "left").where("last IS NULL OR game_num <= last")
    columns = ["run", "game_num", "wins", "draws", "losses", F.round("llr", 9).alias("llr"), "decision"]
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert {r.run: r.decision for r in out.where("decision <> 'inconclusive'").collect()} == {"strong": "pass", "weak": "fail"}


def test_idle_runs_lose_their_state(spark, tmp_path, rocks):
    games = [("a", 1, "w"), ("a", 2, "d")]
    batches = [games, [("b", 1, "w")], [("a", 1, "l")]]
    seen = [sorted((r.run, r.game_num, r.wins, r.losses) for r in out.collect()) for out in run_stream(spark, tmp_path, batches, idle_ms=1)]
    assert seen[0] == [("a", 1, 1, 0), ("a", 2, 1, 0)]
    # the run's state is gone, so its first game begins it anew
    assert seen[2] == sorted([*seen[0], ("b", 1, 1, 0), ("a", 1, 0, 1)])


def test_ratio_equals_the_column_form(spark):
    from plyspark.functions import elo

    rows = [(w, d, x) for w in (0, 1, 7, 120) for d in (0, 3, 80) for x in (0, 2, 60)]
    c = F.col
    for row in spark.createDataFrame(rows, "w int, d int, l int").withColumn("llr", elo.log_likelihood_ratio(c("w"), c("d"), c("l"), 0.0, 5.0)).collect():
        assert sequential.likelihood_ratio(row.w, row.d, row.l, 0.0, 5.0) == pytest.approx(row.llr, abs=1e-9)


# intake


LOG = struct(("id", T.LongType()), ("name", T.StringType()))


def written(folder, name, lines):
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_files_are_taken_once(spark, tmp_path):
    folder, store = tmp_path / "logs", Store(spark, str(tmp_path / "store"))
    (folder / "deep").mkdir(parents=True)
    written(folder, "a.jsonl", [{"id": 1, "name": "x"}, "", "not json", {"id": 2}])
    written(folder, "deep/b.jsonl", [{"id": 3}])
    written(folder, "c.jsonl", ["  "])
    assert intake.take(store, str(folder), "log", LOG) == Taken(3, 4, 3, 1)
    version = store.version
    assert intake.take(store, str(folder), "log", LOG) == Taken() and store.version == version
    written(folder, "d e+f%20.jsonl", [{"id": 4}, "[]"])
    assert intake.take(store, str(folder), "log", LOG) == Taken(1, 2, 1, 1)
    assert sorted(r.id for r in store.read("log").collect()) == [1, 2, 3, 4] and store.read("log_rejects").count() == 2
    ledger = {r.path.rsplit("/", 1)[1]: (r.lines, r.records, r.rejected) for r in store.read(intake.LEDGER).collect()}
    assert ledger["a.jsonl"] == (3, 2, 1) and ledger["c.jsonl"] == (0, 0, 0) and len(ledger) == 4
    written(folder, "a.jsonl", [{"id": 1, "name": "x"}])
    with pytest.raises(intake.ChangedFile, match="a.jsonl"):
        intake.take(store, str(folder), "log", LOG)
    assert store.read("log").count() == 4


def test_a_failed_intake_leaves_nothing(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "logs", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    written(folder, "a.jsonl", [{"id": 1}, "bad"])
    monkeypatch.setattr(intake, "json_lines", lambda *a: (lambda r: (r[0], r[1].limit(0)))(intake_lines(*a)))
    with pytest.raises(intake.Unreconciled):
        intake.take(store, str(folder), "log", LOG)
    assert store.tables() == []
    monkeypatch.undo()
    assert intake.take(store, str(folder), "log", LOG) == Taken(1, 2, 1, 1)


intake_lines = intake.json_lines
