"""Drift measures on one huge and heavy-tailed group, from stored sketches, and with unequal universes."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import drift as D
from tickspark.sources.tables import workspace


def brute(ref, cur):
    ref, cur = np.round(np.array(ref), 6), np.round(np.array(cur), 6)
    values = np.unique(np.concatenate([ref, cur]))
    gap = np.abs(np.searchsorted(np.sort(ref), values, "right") / len(ref) - np.searchsorted(np.sort(cur), values, "right") / len(cur))
    edges = np.unique(np.round(np.percentile(ref, np.arange(11) * 10), 6))[1:-1]
    shares = [np.maximum(np.bincount(np.searchsorted(edges, x, "right"), minlength=len(edges) + 1) / len(x), 1e-6) for x in (ref, cur)]
    return ((shares[1] - shares[0]) * np.log(shares[1] / shares[0])).sum(), (gap[:-1] * np.diff(values)).sum(), gap.max()


def samples(spark, ref, cur, group="x"):
    r, c = (spark.createDataFrame([(float(x),) for x in v], "value double") for v in (ref, cur))
    return D.both(r, c, []).withColumn("feature", F.lit(group))


def heavy(n, seed):
    rng = random.Random(seed)
    return [math.exp(6 * rng.gauss(0, 1)) for _ in range(n)] + [1e12]


def test_a_heavy_tailed_group_is_spread_and_measured_right(spark):
    ref, cur = heavy(20_000, 1), heavy(9_000, 2)
    s = samples(spark, ref, cur).cache()
    per = [r["count"] for r in D.ranged(s, ["feature"], 32).groupBy("_p").count().collect()]
    assert max(per) < 0.05 * sum(per)
    r = D.measures(s, ["feature"], parts=32).first()
    psi, wasserstein, ks = brute(ref, cur)
    assert (r.psi, r.wasserstein, r.ks) == (pytest.approx(psi), pytest.approx(wasserstein), pytest.approx(ks))
    assert (r.n_reference, r.n_current) == (20_001, 9_001)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_groups_that_share_ranges(spark, parts):
    rng = random.Random(parts)
    data = {g: ([rng.choice([rng.gauss(0, 1), rng.randint(0, 3)]) for _ in range(rng.randint(1, 300))], [rng.gauss(0.5, 2) for _ in range(rng.randint(1, 200))]) for g in "abcde"}
    frames = [samples(spark, *v, g) for g, v in data.items()]
    s = frames[0]
    for f in frames[1:]:
        s = s.unionByName(f)
    got = {r.feature: r for r in D.measures(s, ["feature"], parts=parts).collect()}
    for g, v in data.items():
        psi, wasserstein, ks = brute(*v)
        assert (got[g].psi, got[g].wasserstein, got[g].ks) == (pytest.approx(psi), pytest.approx(wasserstein), pytest.approx(ks)), g


def test_one_side_only_and_no_rows(spark):
    assert D.measures(samples(spark, [], [])).isEmpty()
    only = D.measures(samples(spark, [1, 2], [])).first()
    assert only.wasserstein is None and only.n_current == 0
    other = D.measures(samples(spark, [], [1, 2])).first()
    assert other.psi is None and other.n_reference == 0
    assert D.distribution_distance(samples(spark, [], [1, 2])).isEmpty()


def history(spark, shift=0.0, days=200, symbols="AB", per=20):
    rng = random.Random(1)
    rows = []
    for s in symbols:
        for d in range(days):
            for k in range(per):
                close = math.exp(rng.gauss(3, 0.2) + (shift if d >= days - 30 and s == "A" else 0))
                rows.append((s, datetime(2024, 1, 1) + timedelta(days=d, minutes=30 * k), close, rng.random()))
    return spark.createDataFrame(rows, "symbol string, event_timestamp timestamp_ntz, close double, x double")


@pytest.mark.parametrize("shift", [0.0, 2.0])
def test_a_report_from_sketches_agrees_with_the_exact_one(spark, shift):
    rows, w = history(spark, shift).cache(), workspace(spark, "sketches")
    now = F.lit(datetime(2024, 1, 1) + timedelta(days=200)).cast("timestamp_ntz")
    for part in range(2):  # loaded in two parts, the first one twice
        jobs.sketch_days(rows.where((F.dayofyear("event_timestamp") > 100) == bool(part)), w, ["close", "x"])
        jobs.sketch_days(rows.where("dayofyear(event_timestamp) <= 100"), w, ["close", "x"])
    ref, cur = D.periods(rows, now)
    exact = {(r.symbol, r.feature): r for r in D.symbol_drift(ref, cur, ["close", "x"]).collect()}
    turn, since = F.to_date(now - F.expr("interval 30 days")), F.to_date(now - F.expr("interval 180 days"))
    table = spark.read.schema(D.SKETCHED).parquet(w)
    for r in D.sketch_drift(table.where("feature <> 'log_return'"), turn, since).collect():
        want = exact[r.symbol, r.feature]
        assert (r.n_reference, r.n_current) == (want.n_reference, want.n_current)
        assert abs(r.psi - want.psi) <= 0.02 + 0.1 * want.psi and abs(r.wasserstein - want.wasserstein) <= 0.02 * (1 + want.wasserstein)
    report, decided = jobs.drift_report(spark, w, now).first(), D.decision(ref, cur, ["close", "x"]).first()
    assert (report.symbols, report.drifted, report.retrain, report.inconclusive) == (decided.symbols, decided.drifted, decided.retrain, decided.inconclusive)
    assert report.drifted == (1 if shift else 0)


def test_unequal_universes_have_no_decision(spark):
    rows = history(spark, days=60, per=3)
    now = F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz")
    ref, cur = D.periods(rows, now)
    with pytest.raises(Exception, match="different symbols"):
        D.decision(ref, cur.where("symbol = 'A'"), ["close", "x"]).collect()
    w = workspace(spark, "unequal")
    jobs.sketch_days(rows.where("symbol = 'A' or event_timestamp < timestamp'2024-01-20'"), w, ["close", "x"])
    with pytest.raises(Exception, match="different symbols"):
        jobs.drift_report(spark, w, now).collect()


def two_periods(spark, symbols, shifted):
    """(x, y) of each symbol in both periods; x moves for some symbols."""
    s = F.col("id") % symbols
    rows = spark.range(symbols * 60).select(F.concat(F.lit("S"), s.cast("string")).alias("symbol"), s.alias("k"), F.randn(1).alias("x"), F.randn(2).alias("y"), F.randn(3).alias("z"))
    other = spark.range(symbols * 60).select(F.concat(F.lit("S"), s.cast("string")).alias("symbol"), s.alias("k"), (F.randn(4) + F.when(s < shifted, 4.0).otherwise(0.0)).alias("x"), F.randn(5).alias("y"), F.randn(6).alias("z"))
    return rows.drop("k"), other.drop("k")


def test_five_hundred_symbols_in_one_job(spark):
    ref, cur = two_periods(spark, 500, 100)
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    started = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    got = {r.symbol: r for r in D.adversarial_auc(ref, cur, ["x", "y", "z"], trees=5, folds=2).collect()}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - started <= 6  # whatever the number of symbols
    moved = {f"S{i}" for i in range(100)}
    assert len(got) == 500 and all(got[s].separable and got[s].auc > 0.9 and got[s].top_features[0] == "x" for s in moved)
    assert sum(r.separable for s, r in got.items() if s not in moved) <= 20
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= held


def test_samples_of_long_histories_are_bounded(spark):
    ref, cur = two_periods(spark, 1, 1)
    many = ref.crossJoin(spark.range(200)).select("symbol", (F.col("x") + F.col("id") / 1e6).alias("x"), "y", "z")
    r = D.adversarial_auc(many, cur, ["x", "y", "z"], trees=5, most=500).first()
    assert r.separable and r.auc > 0.9
    equal = D.adversarial_auc(ref, ref, ["x", "y", "z"], trees=5).first()
    assert not equal.separable
    assert D.adversarial_auc(ref, cur.limit(0), ["x", "y", "z"]).isEmpty()
