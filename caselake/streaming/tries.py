"""State with an end: next tries of failed keys by timers, phases that are forgotten.

Both need the state store that keeps lists and timers; ``with_state`` sets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from caselake.sources.paged import LONGEST_WAIT, TOO_MANY, wait_before

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state(spark: SparkSession) -> SparkSession:
    """The session, its streams keeping state in RocksDB, beyond a worker's memory."""
    spark.conf.set(_STORE, _ROCKS)
    return spark


class _Tries(StatefulProcessor):
    def __init__(self, key: str, base: float, most: int, keep: int, done: tuple[str, ...], too_many: str) -> None:
        self.key, self.base, self.most, self.keep, self.done, self.too_many = key, base, most, keep, done, too_many

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "tries int, due bigint, forget bigint")
        self.failed = handle.getListState("failed", "ms bigint, status string")

    def _forget(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.now.clear()
        self.failed.clear()

    def _told(self, key: tuple, event: str, tries: int, ms: int) -> pd.DataFrame:
        statuses = ",".join(s or "" for _, s in self.failed.get()) if self.failed.exists() else ""
        return pd.DataFrame({self.key: [key[0]], "event": [event], "tries": [tries], "ms": [ms], "statuses": [statuses]})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        told = sorted((int(ms), s) for f in rows for ms, s in zip(f["ms"], f["status"].fillna("")))
        # what was due before these outcomes comes first, as it would without them
        yield from self._passed(key, timerValues.getCurrentWatermarkInMs())
        tries = self.now.get()[0] if self.now.exists() else 0
        for ms, status in told:
            if status in self.done:
                tries = 0
                self.failed.clear()
            else:
                tries += 1
                self.failed.appendValue((ms, status))
        if not tries:
            self._forget()
            yield self._told(key, "done", 0, ms)
            return
        given_up = tries >= self.most
        due = 0 if given_up else ms + int(1000 * wait_before(tries, self.base, 429 if status == self.too_many else None))
        forget = max(ms, due) + self.keep
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.now.update((tries, due, forget))
        for t in {due, forget} - {0}:
            self.handle.registerTimer(t)
        yield self._told(key, "given up" if given_up else "wait", tries, ms if given_up else due)

    def _passed(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        """What the watermark has passed."""
        tries, due, forget = self.now.get() if self.now.exists() else (0, 0, 0)
        if tries and 0 < due <= mark:
            self.now.update((tries, 0, forget))
            yield self._told(key, "retry", tries, due)
        if tries and forget <= mark:
            yield self._told(key, "forgotten", tries, forget)
            self._forget()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._passed(key, expiredTimerInfo.getExpiryTimeInMs())


def next_tries(stream: DataFrame, key: str, status: str, at: str, delay: str = "1 minute", base: float = 2.0, most: int = 5, keep_seconds: int = 86_400, done: tuple[str, ...] = ("Success",), too_many: str = "429") -> DataFrame:
    """What is to be done with each key: key, event, tries, at and statuses.

    ``stream`` tells outcomes of tries.  After a batch's outcomes of a key there is
    one row: ``done`` after one of ``done``; ``wait`` with the time of the next try,
    that many doublings of ``base`` seconds later (three times that after
    ``too_many``, 300 seconds at most); ``given up`` after ``most`` tries in a row.
    When the watermark (``delay`` behind the latest outcome) passes that time,
    there is a row ``retry``, and ``keep_seconds`` after the last of all one of
    ``forgotten``, with which the state ends; a key that is done has none.  Times
    are those of the outcomes, so a replay gives the same rows.  Rows without key or
    time have no effect; a null status is a failure.  The outcomes of one key in
    one batch are sorted in one task.
    """
    rows = stream.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withWatermark(at, delay)
    rows = rows.select(key, F.col(at).alias("at"), F.unix_millis(at).alias("ms"), F.col(status).cast("string").alias("status"))
    kind = stream.schema[key].dataType.simpleString()
    processor = _Tries(key, base, most, 1000 * keep_seconds, done, too_many)
    out = rows.groupBy(key).transformWithStateInPandas(processor, f"{key} {kind}, event string, tries int, ms bigint, statuses string", "append", "eventTime")
    return out.select(key, "event", "tries", F.timestamp_millis("ms").alias("at"), "statuses")


def wait_seconds(tries: Column, too_many: Column, base: float) -> Column:
    """``wait_before`` as an expression."""
    return F.least(F.lit(LONGEST_WAIT), F.lit(float(base)) * F.pow(F.lit(2.0), F.least(tries, F.lit(61)) - 1) * F.when(too_many, TOO_MANY).otherwise(1.0))


def due_tries(outcomes: DataFrame, key: str, status: str, at: str, order: list[str], base: float = 2.0, most: int = 5, done: tuple[str, ...] = ("Success",), too_many: str = "429") -> DataFrame:
    """The same for a whole table of outcomes: of each key that failed last, tries since it was last done, and when the next is due; null when given up.

    Outcomes of one time go by ``order``.  One aggregate, no state and no window.
    """
    place = F.struct(at, *order)
    rows = outcomes.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, place.alias("p"), F.coalesce(F.col(status).cast("string"), F.lit("")).alias("s"))
    good = rows.groupBy(key).agg(F.max(F.when(F.col("s").isin(*done), F.col("p"))).alias("good"))
    bad = rows.filter(~F.col("s").isin(*done)).join(good, key).filter("good IS NULL OR p > good")
    last = bad.groupBy(key).agg(F.count("*").cast("int").alias("tries"), F.max_by("s", "p").alias("status"), F.max("p").alias("p"))
    wait = wait_seconds(F.col("tries"), F.col("status") == too_many, base)
    due = F.when(F.col("tries") < most, F.timestamp_millis(F.unix_millis(F.col(f"p.{at}").cast("timestamp")) + (wait * 1000).cast("bigint")))
    return last.select(key, "tries", "status", due.alias("due"))


class _Phases(StatefulProcessor):
    def __init__(self, key: str, phase: str, order: list[str], keep: int) -> None:
        self.key, self.phase, self.order, self.keep = key, phase, order, keep
        self.rank = {name: i for i, name in enumerate(order, 1)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "rank int", self.keep)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = self.best.get()[0] if self.best.exists() else 0
        seen = max((self.rank.get(p, 0) for f in rows for p in f[self.phase]), default=0)
        if seen > best:
            self.best.update((seen,))
            yield pd.DataFrame({self.key: [key[0]], self.phase: [self.order[seen - 1]], "rank": [seen]})


def furthest_phase_kept(stream: DataFrame, key: str, phase: str, order: list[str], keep_seconds: int) -> DataFrame:
    """As ``incremental.furthest_phase``, but a key is forgotten ``keep_seconds`` after it last went on, by the clock."""
    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).transformWithStateInPandas(_Phases(key, phase, order, 1000 * keep_seconds), f"{key} {kind}, {phase} string, rank int", "update", "processingTime")
