import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import calendar as C
from tickspark.operators import coverage as V
from tickspark.operators import drift as D
from tickspark.operators import evaluation as E
from tickspark.operators import pointintime as P
from tickspark.operators import quality as Q
from tickspark.operators import training as TR
from tickspark.sources import trades as T

BAR = "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open double, high double, low double, close double, total_volume double"


def bar(symbol, start, price=1.0, volume=1.0):
    return (symbol, start, start + timedelta(minutes=30), price, price, price, price, volume)


def test_decoding_keeps_milliseconds_and_bad_json_becomes_nulls(spark):
    rows = [(b'{"symbol": "A", "price": 1.5, "volume": 2, "timestamp": 1790000000123}',), (b"not json",)]
    got = T.decode(spark.createDataFrame(rows, "value binary")).withColumn("ms", F.unix_millis("event_time")).collect()
    assert got[0].ms == 1790000000123 and got[1].symbol is None and got[1].event_time is None


def test_volume_zero_is_valid_and_reasons_add_up(spark):
    rows = [("A", 1.0, 0.0, 1, datetime(2024, 1, 1)), (" ", -1.0, None, 0, None), ("B", float("nan"), 1.0, 1, datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "symbol string, price double, volume double, timestamp long, event_time timestamp_ntz")
    valid, dead = Q.split(df, late=None)
    assert {r.symbol for r in valid.collect()} == {"A", "B"}
    assert [r.dq_reason for r in dead.collect()] == ["missing_symbol;invalid_price;invalid_volume;invalid_timestamp;invalid_event_time"]
    assert [r.symbol for r in Q.tag(df, Q.trade_rules(late=None, finite=True)).where("dq_reason = 'non_finite'").collect()] == ["B"]


def test_bars_do_not_shift_when_resampled(spark):
    start = datetime(2024, 1, 1, 10)
    one = spark.createDataFrame([bar("A", start)], BAR)
    assert B.resample(one, "30 minutes").first().window_start == start


def test_rolling_rejects_unknown_features_and_missing_columns(spark):
    one = spark.createDataFrame([bar("A", datetime(2024, 1, 1))], BAR)
    with pytest.raises(ValueError, match="unknown"):
        B.rolling(one, ["nope"])
    with pytest.raises(ValueError, match="missing"):
        B.rolling(one.drop("close"))


def test_bounded_history_gives_the_same_features_as_all_history(spark):
    start = datetime(2026, 9, 1)
    rows = [bar(s, start + timedelta(minutes=30 * i), float(i + 1)) for s in "AB" for i in range(300)]
    bars = spark.createDataFrame(rows, BAR)
    opening, closing = F.lit(start + timedelta(minutes=30 * 250)).cast("timestamp_ntz"), F.lit(start + timedelta(minutes=30 * 263)).cast("timestamp_ntz")
    some = B.rolling(B.bounded_history(bars, opening, closing)).where(F.col("window_start") >= opening)
    every = B.rolling(bars).where((F.col("window_start") >= opening) & (F.col("window_start") < closing))
    keys = ["symbol", "window_start", "rolling_avg_close", "rolling_volatility_close"]
    assert sorted(map(tuple, some.select(keys).collect())) == sorted(map(tuple, every.select(keys).collect()))


def minute_trades(spark, skip=()):
    start = datetime(2026, 9, 29, 13, 30)
    rows = [(s, start + timedelta(minutes=i), 100.0 + i // 30, 1.0) for s in "AB" for i in range(390) if i not in skip]
    return spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, price double, volume double")


def day(spark):
    return C.sessions(spark.createDataFrame([(date(2026, 9, 29), date(2026, 9, 29))], "first_day date, last_day date"))


@pytest.mark.parametrize(("skip", "passed", "gap"), [((), True, 60.0), ((0, 1, 2), False, 180.0), ((100, 101, 102), False, 240.0), ((387, 388, 389), False, 240.0)])
def test_tick_coverage_sees_opening_inner_and_closing_gaps(spark, skip, passed, gap):
    got = V.tick_coverage(minute_trades(spark, skip), day(spark)).collect()
    assert {(r.passed, r.max_gap_seconds) for r in got} == {(passed, gap)}
    assert bool(V.trade_gaps(minute_trades(spark, skip), day(spark), ["A", "B"]).count()) is not passed


def test_session_qualification(spark):
    bars = B.ohlcv(minute_trades(spark))
    assert {r.passed for r in V.qualify_sessions(bars, day(spark), ["A", "B"]).collect()} == {True}
    first = bars.where(F.col("window_start") > F.lit("2026-09-29 13:30:00").cast("timestamp_ntz"))
    for broken in (first, bars.unionByName(bars.limit(1)), bars.withColumn("high", F.lit(0.5)), bars.withColumn("total_volume", F.lit(float("nan")))):
        assert False in {r.passed for r in V.qualify_sessions(broken, day(spark), ["A", "B"]).collect()}
    assert {r.passed for r in V.qualify_history(bars, day(spark), ["A", "B"]).collect()} == {True}


def test_digest_does_not_depend_on_order_and_keeps_large_volumes_apart(spark):
    rows = [bar("A", datetime(2024, 1, 1) + timedelta(minutes=30 * i), volume=float(i)) for i in range(9)]
    a, b = (V.content_digest(spark.createDataFrame(r, BAR)).first().digest for r in (rows, rows[::-1]))
    assert a == b
    big = spark.createDataFrame([bar("A", datetime(2024, 1, 1))], BAR)
    assert V.content_digest(big.withColumn("total_volume", F.lit(2**53))).first() != V.content_digest(big.withColumn("total_volume", F.lit(2**53 + 1))).first()


def test_asof_takes_the_latest_within_its_ttl_and_later_created_of_equal_times(spark):
    f = spark.createDataFrame([("A", datetime(2024, 1, 31, 23), 1.0, 1), ("A", datetime(2024, 1, 31, 23), 2.0, 2), ("A", datetime(2024, 2, 2), 3.0, 1)], "symbol string, event_timestamp timestamp_ntz, x double, made int")
    s = spark.createDataFrame([("A", datetime(2024, 1, 31, 22)), ("A", datetime(2024, 2, 1, 3)), ("A", datetime(2024, 2, 1, 23)), ("A", datetime(2024, 2, 2)), ("B", datetime(2024, 2, 2))], "symbol string, event_timestamp timestamp_ntz")
    got = {(r.symbol, r.event_timestamp): r.x for r in P.asof(s, f, ["x"], "6 hours", created="made").collect()}
    assert list(got.values()).count(None) == 3
    assert got["A", datetime(2024, 2, 1, 3)] == 2.0 and got["A", datetime(2024, 2, 2)] == 3.0


def test_split_never_leaks(spark):
    start = datetime(2026, 1, 1)
    rows = [(s, start + timedelta(minutes=30 * i), 1.0) for s, skip in (("A", 0), ("B", 5), ("C", 0)) for i in range(12 if s == "C" else 0, 60) if not (skip and i % skip == 0)]
    df = spark.createDataFrame(rows, "symbol string, event_timestamp timestamp_ntz, close double")
    cut = TR.cutoff(df, 0.25).first().cutoff
    assert cut == datetime(2026, 1, 1, 22)
    train, val, bound = TR.temporal_split(df, 0.25, 8, 3)
    assert train.agg(F.max("event_timestamp")).first()[0] <= cut
    index = TR.decoder_index(val, bound, 8, 3).where("in_holdout")
    assert TR.leaks(index, TR.time_index(df, "event_timestamp"), TR.cutoff(df, 0.25)).isEmpty()
    with pytest.raises(ValueError):
        TR.cutoff(df, 1.5)


def samples(spark, ref, cur):
    r, c = (spark.createDataFrame([(float(x),) for x in v], "value double") for v in (ref, cur))
    return D.both(r, c, []).withColumn("feature", F.lit("x"))


def test_psi_of_constants_and_of_samples_far_apart(spark):
    assert D.psi(samples(spark, range(100), range(1000, 1100))).first().psi > 0.2
    assert D.psi(samples(spark, [1] * 60, [2] * 30)).first().psi == math.inf
    assert D.psi(samples(spark, [1] * 60, [1] * 30)).first().psi == 0.0
    assert D.distribution_distance(samples(spark, [1] * 60, [2] * 30)).first().wasserstein == 1.0


def test_crossing_quantiles_are_counted_and_gates_named(spark):
    rows = [(i, 1, q, i / 100, i / 100 + (0.1 if q < 0.5 else 0.0)) for i in range(100) for q in (0.1, 0.5, 0.9)]
    f = spark.createDataFrame(rows, "sample_id int, horizon int, quantile double, y_true double, y_pred double")
    e = E.evidence(f).first()
    assert e.crossings == 100 and e.sample_count == 100 and e.mae == 0
    m = spark.createDataFrame([(0.1, 0.5, 0.3, 10, 0.1, 0.0, 0.5), (float("nan"), 0.5, 0.3, 200, 0.1, 0.1, 0.0)], "mae double, hit_rate double, composite_score double, sample_count int, baseline_mae double, baseline_mae_improvement double, maximum_calibration_error double")
    assert [r.failures for r in E.failures(m).collect()] == [["insufficient_samples", "baseline_not_beaten", "poor_calibration"], ["missing_or_nonfinite_metrics"]]


def test_price_paths_accumulate(spark):
    f = spark.createDataFrame([(1, h, 0.5, 0.0, h / 100) for h in (1, 2, 3)], "sample_id int, horizon int, quantile double, y_true double, y_pred double")
    offsets = spark.createDataFrame([(h, 0.5, 0.0) for h in (1, 2, 3)], "horizon int, quantile double, offset double")
    base = spark.createDataFrame([(1, 100.0)], "sample_id int, base_price double")
    got = [r.price for r in E.price_paths(f, offsets, base).orderBy("horizon").collect()]
    assert got == pytest.approx([100 * math.exp(x) for x in (0.01, 0.03, 0.06)])


def test_separable_periods_have_a_high_auc(spark):
    rows = [("A", float(i), float(i % 7)) for i in range(120)]
    ref = spark.createDataFrame(rows, "symbol string, x double, y double")
    far = ref.withColumn("x", F.col("x") + 1000)
    assert D.adversarial_auc(ref, far, ["x", "y"], trees=5).first().auc > 0.95


def test_empty_tables(spark):
    none = spark.createDataFrame([], BAR)
    trades = spark.createDataFrame([], "symbol string, event_time timestamp_ntz, price double, volume double, timestamp long")
    assert B.ohlcv(trades).isEmpty() and B.rolling(none).isEmpty() and Q.impute(none, ["close"], order="window_start").isEmpty()
    assert V.tick_coverage(trades, day(spark)).isEmpty()
    assert V.missing_bars(none, day(spark), ["A"]).count() == 13
    assert Q.split(trades)[0].isEmpty() and Q.duplicate_payloads(trades).isEmpty()


def test_bounded_collect(spark):
    from tickspark.functions.bounded import TooManyRows, collect_bounded

    assert len(collect_bounded(spark.range(5), 5)) == 5
    with pytest.raises(TooManyRows):
        collect_bounded(spark.range(6), 5)
