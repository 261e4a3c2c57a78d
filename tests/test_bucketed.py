"""As-of joins and look-ups over buckets: equal rows, no shuffle of the history, few buckets read."""

import glob
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark.operators import pointintime as P
from tickspark.sources import bucketed
from tickspark.sources.tables import workspace


def made(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 25)
    f = [(s, start + timedelta(hours=rng.randrange(0, 900)), rng.random(), start + timedelta(seconds=i)) for i, s in enumerate("AAABBC" * 60)]
    features = spark.createDataFrame(f, "symbol string, event_timestamp timestamp_ntz, x double, made timestamp_ntz")
    p = [(s, start + timedelta(hours=rng.randrange(-50, 1000), minutes=rng.choice([0, 0, 30]))) for s in "ABCD" * 60] + [(None, start)]
    return spark.createDataFrame(p, "symbol string, event_timestamp timestamp_ntz"), features


@pytest.mark.parametrize("ttl", ["2 hours", "100 hours", "1000 hours"])
def test_a_bucketed_history_gives_what_a_sort_gives(spark, ttl):
    spine, features = made(spark, 1)
    path = workspace(spark, "hist")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bucketed.write_history(features, name, ["x"], ttl, path, buckets=4, created="made")
    got = sorted(map(tuple, bucketed.asof_history(spine, name, ["x"], ttl).collect()), key=str)
    assert got == sorted(map(tuple, P.asof(spine, features, ["x"], ttl, created="made").collect()), key=str)


def test_the_history_is_not_shuffled(spark):
    spine, features = made(spark, 2)
    path = workspace(spark, "plan")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bucketed.write_history(features, name, ["x"], "2 hours", path, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = bucketed.asof_history(spine, name, ["x"], "2 hours")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    side = plan[plan.index("SortMergeJoin") :].split("Exchange hashpartitioning")
    assert "FileScan" in side[1] and "FileScan" not in side[0]


def test_a_look_up_reads_the_buckets_of_its_keys(spark):
    online = spark.range(1000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), F.col("id").cast("double").alias("close"))
    path = workspace(spark, "online")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bucketed.write_online(online, name, path, buckets=32)
    asked = ["S1", "S2", "nobody"]
    needed = {r.b for r in spark.createDataFrame([(k,) for k in asked], "symbol string").select(F.pmod(F.hash("symbol"), F.lit(32)).alias("b")).collect()}
    spoiled = 0
    for file in glob.glob(f"{path.removeprefix('file:')}/part-*.parquet"):
        if int(re.search(r"_(\d{5})\.", file)[1]) not in needed:
            spoiled += 1
            with open(file, "wb") as f:
                f.write(b"not to be read")
    assert spoiled >= 20
    spark.catalog.refreshTable(name)
    out = bucketed.look_up(spark, name, asked)
    assert {(r.symbol, r.close, r.missing) for r in out.collect()} == {("S1", 1.0, False), ("S2", 2.0, False), ("nobody", None, True)}
    with pytest.raises(Exception, match="."):
        spark.table(name).count()
    assert bucketed.look_up(spark, name, []).isEmpty()
