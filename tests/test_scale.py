"""Operators that are cut to slices, blocks and nodes, against the plain computation over all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark.operators import coverage as V
from tickspark.operators import quality as Q
from tickspark.operators import training as TR
from tickspark.schemas import BAR

START = datetime(2024, 1, 30, 12)


def bars(spark, n, symbols="AB", seed=1):
    rng = random.Random(seed)
    rows = [(s, START + timedelta(minutes=30 * i), START + timedelta(minutes=30 * (i + 1)), *[rng.random() for _ in range(4)], 1.0 + i) for s in symbols for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, total_volume double").select([f.name for f in BAR.fields])


def test_the_tree_knows_no_order_and_names_what_differs(spark):
    b = bars(spark, 400).cache()
    tree = V.digest_tree(b)
    again = V.digest_tree(b.orderBy(F.rand(3)).repartition(7))
    assert tree.where("level = 0").first().digest == again.where("level = 0").first().digest
    assert tree.agg(F.max("children")).first()[0] <= 256
    assert V.differences(tree, again).isEmpty()
    changed = b.withColumn("close", F.when((F.col("symbol") == "A") & (F.col("window_start") == START + timedelta(days=3)), 9.0).otherwise(F.col("close"))).where(~((F.col("symbol") == "B") & (F.to_date("window_start") == "2024-02-04")))
    got = {(r.symbol, str(r.day), r.side) for r in V.differences(tree, V.digest_tree(changed)).collect()}
    assert got == {("A", "2024-02-02", "changed"), ("B", "2024-02-04", "left")}
    assert V.content_digest(b.limit(0)).first().groups == 0 and V.differences(V.digest_tree(b.limit(0)), tree).where("side <> 'right'").isEmpty()


def gaps(spark, seed):
    rng = random.Random(seed)
    rows = []
    for s in ["A", "B", None, "C"]:
        for i in range(150):
            at = datetime(2024, 1, 1) + timedelta(hours=13 * i)
            rows.append((s, at, None if s == "C" or rng.random() < 0.6 or (s == "B" and i < 70) or (s == "A" and i > 100) else float(i), None if rng.random() < 0.9 else str(i)))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, x double, y string")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("backfill", ["symbol", "global"])
def test_fills_carry_over_slices(spark, seed, backfill):
    rows, df = gaps(spark, seed)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    want = {}
    for c in (2, 3):
        for k, r in enumerate(ordered):
            past = [q[c] for q in ordered[: k + 1] if q[0] == r[0] and q[c] is not None]
            ahead = [q[c] for q in ordered[k:] if (q[0] == r[0] or backfill == "global") and q[c] is not None]
            want[r[0], r[1], c] = past[-1] if past else ahead[0] if ahead else None
    for r in Q.impute(df, ["x", "y"], backfill=backfill).collect():
        assert (r.x, r.y) == (want[r.symbol, r.event_time, 2], want[r.symbol, r.event_time, 3])


def test_no_fill_sorts_a_whole_history(spark):
    plan = Q.impute(gaps(spark, 1)[1], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "Window [" in line and "x#" in line]
    assert rows and all("_slice" in line for line in rows)


@pytest.mark.parametrize(("encoder", "horizon", "block"), [(8, 3, 5), (8, 3, 11), (7, 1, None), (40, 9, 50)])
def test_packed_examples_equal_frames(spark, encoder, horizon, block):
    rng = random.Random(encoder)
    rows = [(s, i, rng.random(), None if rng.random() < 0.1 else rng.random()) for s, n in (("A", 90), ("B", 33), ("C", 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, time_idx int, x double, y double")
    frames = {(r.symbol, r.time_idx): r for r in TR.sequence_examples(df.fillna(-1.0), ["x", "y"], encoder, horizon).collect()}
    packed = TR.packed_examples(df.fillna(-1.0), ["x", "y"], encoder, horizon, block=block).collect()
    assert len(packed) == len(frames)
    for r in packed:
        f = frames[r.symbol, r.time_idx]
        assert r.x_encoder == [v.x for v in f.encoder] and r.y_decoder == [v.y for v in f.decoder]
        assert r.y_encoder == [v.y for v in f.encoder] and r.x_decoder == [v.x for v in f.decoder]


def test_packed_examples_of_an_index_and_what_they_shuffle(spark):
    df = spark.range(5000).select(F.lit("A").alias("symbol"), F.col("id").alias("time_idx"), F.rand(1).alias("x"))
    index = df.where("time_idx % 17 = 0").select("symbol", F.col("time_idx").alias("time_idx_first_prediction"))
    got = TR.packed_examples(df, ["x"], 100, 10, index, block=1000)
    assert {r.time_idx for r in got.select("time_idx").collect()} == {i for i in range(0, 5000, 17) if i >= 50}
    assert TR.packed_examples(df.limit(0), ["x"], 100, 10).isEmpty()
    first, last = F.floor(F.greatest(F.col("time_idx") - 9, F.lit(0)) / 1000), F.floor((F.col("time_idx") + 100) / 1000)
    assert df.select(F.sum(last - first + 1)).first()[0] <= 1.2 * 5000
