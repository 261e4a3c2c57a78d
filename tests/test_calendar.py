from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickspark.operators import calendar as C


def sessions(spark, first, last):
    days = spark.createDataFrame([(date.fromisoformat(first), date.fromisoformat(last))], "first_day date, last_day date")
    return {r.session_date.isoformat(): r for r in C.sessions(days).collect()}


@pytest.mark.parametrize(
    ("year", "closed"),
    [
        (2024, ["01-01", "01-15", "02-19", "03-29", "05-27", "06-19", "07-04", "09-02", "11-28", "12-25"]),
        (2021, ["01-01", "01-18", "02-15", "04-02", "05-31", "07-05", "09-06", "11-25", "12-24"]),
        (2022, ["01-17", "02-21", "04-15", "05-30", "06-20", "07-04", "09-05", "11-24", "12-26"]),
        (2026, ["01-01", "01-19", "02-16", "04-03", "05-25", "06-19", "07-03", "09-07", "11-26", "12-25"]),
    ],
)
def test_holidays_of_a_year(spark, year, closed):
    have = sessions(spark, f"{year}-01-01", f"{year}-12-31")
    days = [date.fromordinal(i) for i in range(date(year, 1, 1).toordinal(), date(year, 12, 31).toordinal() + 1)]
    weekdays = {d.isoformat() for d in days if d.weekday() < 5}
    assert sorted(weekdays - set(have)) == [f"{year}-{c}" for c in closed]


def test_early_closes_and_daylight_saving(spark):
    s = sessions(spark, "2026-07-01", "2026-12-31")
    assert [d for d, r in s.items() if r.is_early_close] == ["2026-11-27", "2026-12-24"]
    assert s["2026-09-29"].market_open == datetime(2026, 9, 29, 13, 30) and s["2026-09-29"].market_close == datetime(2026, 9, 29, 20)
    assert s["2026-11-27"].market_open == datetime(2026, 11, 27, 14, 30) and s["2026-11-27"].market_close == datetime(2026, 11, 27, 18)


def test_a_session_has_13_bars_and_an_early_one_7(spark):
    days = spark.createDataFrame([(date(2026, 11, 25), date(2026, 11, 27))], "first_day date, last_day date")
    n = {r.session_date.isoformat(): r["count"] for r in C.session_grid(C.sessions(days)).groupBy("session_date").count().collect()}
    assert n == {"2026-11-25": 13, "2026-11-27": 7}


def test_future_bars_skip_the_weekend(spark):
    days = spark.createDataFrame([(date(2026, 7, 9), date(2026, 7, 20))], "first_day date, last_day date")
    latest = spark.createDataFrame([("A", datetime(2026, 7, 10, 19, 30))], "symbol string, event_timestamp timestamp_ntz")
    got = [r.event_timestamp for r in C.future_bars(latest, C.sessions(days), 3).orderBy("step").collect()]
    assert got == [datetime(2026, 7, 10, 20), datetime(2026, 7, 13, 14), datetime(2026, 7, 13, 14, 30)]


def test_freshness(spark):
    days = spark.createDataFrame([(date(2026, 9, 21), date(2026, 9, 30))], "first_day date, last_day date")
    cuts = spark.createDataFrame([(datetime(2026, 9, 25, 20),), (datetime(2026, 9, 28, 20),), (datetime(2026, 9, 28, 19),), (datetime(2026, 9, 30, 20),)], "cutoff timestamp_ntz")
    got = {r.cutoff.isoformat(): r.status for r in C.freshness(cuts, C.sessions(days), F.lit("2026-09-28 21:30:00").cast("timestamp_ntz")).collect()}
    assert got == {"2026-09-25T20:00:00": "stale", "2026-09-28T20:00:00": "fresh", "2026-09-28T19:00:00": "off_session", "2026-09-30T20:00:00": "future"}


def test_days_on_which_the_exchange_stayed_closed(spark):
    closed = {"2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09"}
    spans = [("2001-09-03", "2001-09-18"), ("2004-06-07", "2004-06-15"), ("2006-12-28", "2007-01-05"), ("2012-10-26", "2012-11-01"), ("2018-12-03", "2018-12-07"), ("2025-01-06", "2025-01-10")]
    days = spark.createDataFrame(spans, "first_day string, last_day string").select(F.to_date("first_day").alias("first_day"), F.to_date("last_day").alias("last_day"))
    open_days = {str(r.session_date) for r in C.sessions(days).collect()}
    assert not closed & open_days and {"2001-09-10", "2001-09-17", "2018-12-04", "2025-01-10"} <= open_days
    assert closed <= {str(r.session_date) for r in C.sessions(days, ()).collect()}


def test_future_bars_equal_a_scan_of_all_ends(spark):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(4)
    days = spark.createDataFrame([("2024-11-20", "2024-12-31")], "first_day string, last_day string").select(F.to_date("first_day").alias("first_day"), F.to_date("last_day").alias("last_day"))
    sess = C.sessions(days)
    ends = sorted(r.window_start + timedelta(minutes=30) for r in C.session_grid(sess).collect())
    lasts = [(f"S{i}", datetime(2024, 11, 10) + timedelta(minutes=rng.randrange(0, 60 * 24 * 56))) for i in range(200)] + [("E", ends[5]), ("L", ends[-1]), ("P", ends[-3])]
    latest = spark.createDataFrame(lasts, "symbol string, event_timestamp timestamp_ntz")
    out = C.future_bars(latest, sess, 7)
    got = sorted((r.symbol, r.step, r.event_timestamp) for r in out.collect())
    assert got == sorted((s, k + 1, e) for s, t in lasts for k, e in enumerate([e for e in ends if e > t][:7]))
    assert "NestedLoop" not in out.where("symbol = 'E'")._jdf.queryExecution().executedPlan().toString().replace("BroadcastNestedLoopJoin BuildRight, Cross", "")
    assert C.future_bars(latest.limit(0), sess, 3).isEmpty() and C.future_bars(latest, sess.limit(0), 3).isEmpty()
