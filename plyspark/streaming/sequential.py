"""Sequential tests over a stream of games that stop themselves.

Games of a run may come in any order and more than once. They count in order of game number, from 1: one that comes early waits in
state for those before it. After each game there is a row; once the ratio decides, nothing more is given out. What a run holds is
removed when nothing has come for it for a while, by a timer that the next batch fires.

A query with timers asks for batches without end; one that shall end when its input is read (``availableNow``) needs
``spark.sql.streaming.noDataMicroBatches.enabled`` off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Milliseconds without a game after which a run's state goes.
IDLE_MS = 7_200_000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROWS = "run string, game_num long, wins long, draws long, losses long, llr double, decision string"


def likelihood_ratio(wins: int, draws: int, losses: int, elo0: float, elo1: float) -> float:
    """As ``functions.elo.log_likelihood_ratio``, for one run in a task."""
    w, d, lost = wins + 0.5, draws + 0.5, losses + 0.5
    n = w + d + lost
    draw = -200.0 * math.log10(w / (n - w) * lost / (n - lost))
    x = 10.0 ** (-draw / 400.0)
    scale = 4.0 * x / (1.0 + x) ** 2
    score = lambda e: 1.0 / (1.0 + 10.0 ** (-e / 400.0))
    chances = [(score(b - draw), 1.0 - score(b - draw) - score(-b - draw), score(-b - draw)) for b in (elo0 / scale, elo1 / scale)]
    if wins + draws + losses == 0 or min(map(min, chances)) <= 0:
        return 0.0
    return sum(k * math.log(one / zero) for k, zero, one in zip((w, d, lost), *chances, strict=True))


class SequentialTest(StatefulProcessor):
    """The state of one run: its tally and next game number, and games that came early."""

    def __init__(self, elo0: float, elo1: float, alpha: float, beta: float, idle_ms: int):
        self.elo0, self.elo1, self.idle_ms = elo0, elo1, idle_ms
        self.low, self.high = math.log(beta / (1 - alpha)), math.log((1 - beta) / alpha)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tally = handle.getValueState("tally", "wins long, draws long, losses long, next long, decided boolean")
        self.early = handle.getMapState("early", "game_num long", "outcome string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        wins, draws, losses, following, decided = self.tally.get() if self.tally.exists() else (0, 0, 0, 1, False)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        out = []
        for part in rows:
            if decided:
                continue
            come = {int(n): o for n, o in zip(part["game_num"], part["outcome"], strict=True) if n >= following and o in ("w", "d", "l")}
            for n, o in come.items():
                if not self.early.containsKey((n,)):
                    self.early.updateValue((n,), (o,))
            while not decided and self.early.containsKey((following,)):
                (outcome,) = self.early.getValue((following,))
                self.early.removeKey((following,))
                wins, draws, losses = wins + (outcome == "w"), draws + (outcome == "d"), losses + (outcome == "l")
                llr = likelihood_ratio(wins, draws, losses, self.elo0, self.elo1)
                decision = "pass" if llr >= self.high else "fail" if llr <= self.low else "inconclusive"
                out.append((key[0], following, wins, draws, losses, llr, decision))
                following, decided = following + 1, decision != "inconclusive"
            if decided:
                self.early.clear()
        self.tally.update((wins, draws, losses, following, decided))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.tally.clear()
        self.early.clear()
        return iter(())

    def close(self) -> None:
        pass


def sequential_tests(games: DataFrame, elo0: float = 0.0, elo1: float = 10.0, alpha: float = 0.05, beta: float = 0.05, idle_ms: int = IDLE_MS) -> DataFrame:
    """From a stream of games (run, game_num from 1, outcome w, d or l): a row after each game until its run is decided.

    A game number that comes again counts once; other outcomes are no games. The session needs ``PROVIDER`` as its state store.
    """
    test = SequentialTest(elo0, elo1, alpha, beta, idle_ms)
    return games.groupBy("run").transformWithStateInPandas(statefulProcessor=test, outputStructType=ROWS, outputMode="Append", timeMode="ProcessingTime")
