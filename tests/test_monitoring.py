"""Error budgets over hours that cross midnight, holding times, and merged latency sketches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark.operators import monitoring as M


def rollup(spark, rows):
    return spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(minutes=m), n, e, p) for m, n, e, p in rows], "window_start timestamp_ntz, requests long, error_ratio double, p95_latency double")


def test_the_hour_knows_no_midnight(spark):
    got = {r.window_start.minute: r for r in M.burn(rollup(spark, [(1435, 100, 0.10, 0.1), (1440, 100, 0.06, 0.1)])).collect()}
    assert got[0].hour_error_ratio == pytest.approx(0.08) and got[55].hour_error_ratio == pytest.approx(0.1)
    assert len(got) == 2 and got[0].burn_firing and not got[55].burn_firing


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_burn_equals_a_scan_of_all_windows(spark, seed):
    rng = random.Random(seed)
    rows = [(5 * i, rng.randint(1, 9), rng.choice([0.0, 0.02, 0.06, 0.2]), rng.choice([0.5, 1.5])) for i in sorted(rng.sample(range(900), 700))]
    by = {m: (n, e, p) for m, n, e, p in rows}

    def conditions(m):
        hour = [by[x] for x in range(m - 55, m + 1, 5) if x in by]
        ratio = sum(n * e for n, e, _ in hour) / sum(n for n, _, _ in hour)
        return ratio, by[m][1] > 0.05 and ratio > 0.01, by[m][2] > 1.0

    for r in M.burn(rollup(spark, rows)).collect():
        m = int((r.window_start - datetime(2024, 1, 1)).total_seconds() // 60)
        ratio, burning, slow = conditions(m)
        assert r.hour_error_ratio == pytest.approx(ratio) and (r.availability_burn, r.slow) == (burning, slow)
        assert r.burn_firing == all(x in by and conditions(x)[1] for x in (m - 5, m))
        assert r.slow_firing == all(x in by and conditions(x)[2] for x in (m - 10, m - 5, m))


def test_merged_sketches_stay_within_their_rank_error(spark):
    n = 200_000
    ts = F.timestamp_seconds(F.lit(1_704_153_600) + F.col("id") % 3600).cast("timestamp_ntz")
    requests = spark.range(n).select(ts.alias("ts"), F.lit(200).alias("status"), F.pow(F.rand(1), F.lit(4)).alias("latency"), F.lit(False).alias("cached"))
    last = M.sliding_slo(M.slo_slices(requests)).orderBy(F.desc("window_start")).first()
    rank = requests.where(F.col("latency") <= last.p95_latency).count() / n
    assert last.requests == n and abs(rank - 0.95) <= 0.001


def test_a_halo_is_shorter_than_its_slice(spark):
    with pytest.raises(ValueError):
        M.with_halo(rollup(spark, [(0, 1, 0.0, 0.0)]), 86_400)
