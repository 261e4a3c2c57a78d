"""Liveness of symbols from the stream itself: state and event-time timers say when a symbol falls silent and when it is back.

A symbol's trades form runs, in which no two neighbours lie further apart than the limit. Tasks cut their trades to runs before
anything is shuffled, so that a symbol with most of all trades costs a few rows a task. The state holds the runs that the
watermark has not settled: a run is over when the watermark has passed its last trade by the limit, and gives a ``stale`` row at
that moment; the start of the next one gives an ``alive`` row once the watermark has passed it. A timer is set for the
moment to come, so a row appears without any later trade of the symbol, at the batch in which the watermark gets there.

A symbol's first trade gives no row; a trade at exactly the limit is in time; trades behind the watermark are dropped, but for
those of a run that reaches past it, which counts whole. Rows without symbol or time are left out."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LIMIT = 120
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENTS = "symbol string, status string, at timestamp"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State with timers needs this store; queries keep the one that was set when they started."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def merged(spans: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Spans in order, those within the limit of one another as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a - out[-1][1] <= limit:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def runs(trades: DataFrame, seconds: int = LIMIT) -> DataFrame:
    """symbol, started, event_time: the runs of each batch of rows as they lie, not moved."""
    limit = seconds * 1000

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = part.sort_values(["symbol", "ms"], kind="stable")
            new = (rows["symbol"] != rows["symbol"].shift()) | (rows["ms"] - rows["ms"].shift() > limit)
            grouped = rows.groupby(new.cumsum(), sort=False)
            yield pd.DataFrame({"symbol": grouped["symbol"].first(), "a": grouped["ms"].min(), "b": grouped["ms"].max()})

    each = trades.where("symbol is not null and event_time is not null").select("symbol", F.unix_millis("event_time").alias("ms"))
    return each.mapInPandas(cut, "symbol string, a long, b long").select("symbol", F.timestamp_millis("a").alias("started"), F.timestamp_millis("b").alias("event_time"))


class Liveness(StatefulProcessor):
    def __init__(self, seconds: int = LIMIT):
        self.limit = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", "a long, b long")
        self.silent = handle.getValueState("silent", "silent boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans = [(a, b) for a, b in self.spans.get()]
        for part in rows:
            ms = [part[c].to_numpy().astype("datetime64[ms]").astype("int64").tolist() for c in ("started", "event_time")]
            spans += zip(*ms, strict=True)
        yield self.settle(key, merged(spans, self.limit), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.settle(key, [(a, b) for a, b in self.spans.get()], timerValues.getCurrentWatermarkInMs())

    def settle(self, key, spans: list[tuple[int, int]], watermark: int) -> pd.DataFrame:
        """The rows that the watermark allows; what is left goes to the state, with a timer for the next moment."""
        silent, out = self.silent.exists() and self.silent.get()[0], []
        due = None
        while spans and due is None:
            a, b = spans[0]
            moment = a if silent else b + self.limit
            if moment > watermark:
                due = moment
                continue
            out.append((key[0], "alive" if silent else "stale", pd.Timestamp(moment, unit="ms", tz="UTC")))
            if not silent:
                spans = spans[1:]
            silent = not silent
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if due is not None:
            self.handle.registerTimer(due)
        self.silent.update((silent,))
        self.spans.put(spans) if spans else self.spans.clear()
        return pd.DataFrame(out, columns=["symbol", "status", "at"])

    def close(self) -> None:
        pass


def transitions(trades: DataFrame, watermark: str = "10 seconds", seconds: int = LIMIT) -> DataFrame:
    """symbol, status (``stale`` or ``alive``) and the moment, of a stream with symbol and event_time."""
    keyed = runs(trades, seconds).withWatermark("event_time", watermark).groupBy("symbol")
    return keyed.transformWithStateInPandas(Liveness(seconds), EVENTS, "Append", "EventTime")
