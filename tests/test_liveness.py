"""Stale and alive rows from the stream alone: gaps, timers, late rows, restarts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark.sources.tables import workspace
from tickspark.streaming import live
from tickspark.streaming.liveness import merged, rocksdb, transitions

START = datetime(2024, 1, 2)
TRADES = "symbol string, event_time timestamp"


def expected(rows, watermark):
    out = []
    for s in {s for s, _ in rows}:
        spans = merged([(t, t) for x, t in rows if x == s], 120)
        for i, (a, b) in enumerate(spans):
            if i and a <= watermark:
                out.append((s, "alive", a))
            if b + 120 <= watermark:
                out.append((s, "stale", b + 120))
    return sorted(out)


class Source:
    """Files that are read in the order in which they are written."""

    def __init__(self, spark):
        self.spark, self.w, self.n = spark, workspace(spark, "liveness"), 0
        (spark.createDataFrame([], TRADES).write.parquet(f"{self.w}/in/empty"))

    def add(self, rows):
        moments = [(s, START + timedelta(seconds=t)) for s, t in rows]
        self.spark.createDataFrame(moments, TRADES).coalesce(1).write.parquet(f"{self.w}/in/{self.n:03d}")
        self.n += 1

    def run(self):
        s = self.spark.readStream.schema(TRADES).option("recursiveFileLookup", "true").parquet(f"{self.w}/in")
        with rocksdb(self.spark):
            live.append(transitions(s), f"{self.w}/out", f"{self.w}/cp", {"availableNow": True}, "liveness").awaitTermination()

    def found(self):
        rows = self.spark.read.parquet(f"{self.w}/out").select("symbol", "status", F.unix_seconds("at").alias("t")).collect()
        zero = int((START - datetime(1970, 1, 1)).total_seconds())
        return sorted((r.symbol, r.status, r.t - zero) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_one_run_equals_all_gaps(spark, seed):
    rng = random.Random(seed)
    rows = [(s, t) for s in "ABC" for t in rng.sample(range(20_000), 150)]
    rng.shuffle(rows)
    source = Source(spark)
    source.add(rows)
    source.run()
    assert source.found() == expected(rows, max(t for _, t in rows) - 10)


def test_timers_fire_without_a_later_trade_of_the_symbol_and_survive_restarts(spark):
    source = Source(spark)
    batches = [[("A", 0), ("A", 60), ("B", 50)], [("B", 150)], [("B", 260)], [("B", 380), ("A", 375)], [("B", 480), ("A", 470), ("B", 600)], [("B", 705)]]
    seen, all_rows = [], []
    for batch in batches:
        source.add(batch)
        all_rows += batch
        source.run()  # each run is a restart from the checkpoint
        now = source.found()
        assert now == expected(all_rows, max(t for _, t in all_rows) - 10)  # nothing lost, nothing twice
        assert all(x in now for x in seen)
        seen = now
    assert ("A", "stale", 180) in seen and ("A", "alive", 375) in seen and ("A", "stale", 590) in seen


def test_a_trade_at_the_limit_is_in_time_and_late_rows_are_dropped(spark):
    source = Source(spark)
    source.add([("A", 0), ("A", 120), ("B", 1000)])
    source.run()
    assert source.found() == [("A", "stale", 240)]
    source.add([("A", 200), ("B", 1001)])  # behind the watermark
    source.run()
    assert source.found() == [("A", "stale", 240)]


def test_rows_without_symbol_or_time_are_left_out(spark):
    source = Source(spark)
    spark.createDataFrame([(None, START), ("A", None), ("A", START)], TRADES).write.parquet(f"{source.w}/in/odd")
    source.add([("B", 500)])
    source.run()
    assert source.found() == [("A", "stale", 120)]
