"""Exchange sessions from rules: weekends, holidays with observed days, early closes, daylight saving."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
OPEN, CLOSE, EARLY_CLOSE = "09:30:00", "16:00:00", "13:00:00"
BAR_MINUTES = 30
#: Weekdays on which the exchange stayed closed though no rule says so.
CLOSURES = ("1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")


def _observed(d: Column, month: int, day: int, saturday: bool = True) -> Column:
    """A fixed date, kept on Monday if it falls on a Sunday and on Friday if on a Saturday."""
    fixed = F.make_date(F.year(d), F.lit(month), F.lit(day))
    shift = F.when(F.weekday(fixed) == 6, 1).when((F.weekday(fixed) == 5) & F.lit(saturday), -1).otherwise(0)
    return d == F.date_add(fixed, shift.cast("int"))


def _nth(d: Column, month: int, weekday: int, first: int, last: int) -> Column:
    return (F.month(d) == month) & (F.weekday(d) == weekday) & F.dayofmonth(d).between(first, last)


def good_friday(d: Column) -> Column:
    """Two days before Easter Sunday of the Gregorian calendar."""
    y = F.year(d)
    century, golden = F.floor(y / 100), y % 19
    epact = (century - F.floor(century / 4) - F.floor((8 * century + 13) / 25) + 19 * golden + 15) % 30
    epact = epact - F.floor(epact / 28) * (1 - F.floor(epact / 28) * F.floor(29 / (epact + 1)) * F.floor((21 - golden) / 11))
    sunday = epact - (y + F.floor(y / 4) + epact + 2 - century + F.floor(century / 4)) % 7
    return d == F.date_add(F.make_date(y, F.lit(3), F.lit(28)), (sunday - 2).cast("int"))


def is_holiday(d: Column, closures: Sequence[str] = CLOSURES) -> Column:
    """Full closures on weekdays; ``closures``: dates of exceptional ones."""
    y = F.year(d)
    rules = [
        _observed(d, 1, 1, saturday=False),
        (y >= 1998) & _nth(d, 1, 0, 15, 21),
        _nth(d, 2, 0, 15, 21),
        good_friday(d),
        _nth(d, 5, 0, 25, 31),
        (y >= 2022) & _observed(d, 6, 19),
        _observed(d, 7, 4),
        _nth(d, 9, 0, 1, 7),
        _nth(d, 11, 3, 22, 28),
        _observed(d, 12, 25),
        d.cast("string").isin(list(closures)),
    ]
    return reduce(Column.__or__, rules)


def is_early_close(d: Column) -> Column:
    """The day after Thanksgiving, Christmas Eve and the eve of Independence Day, where these are sessions."""
    monday_to_thursday = F.weekday(d) <= 3
    eve = (F.month(d) == 12) & (F.dayofmonth(d) == 24) | (F.month(d) == 7) & (F.dayofmonth(d) == 3)
    return _nth(d, 11, 4, 23, 29) | eve & monday_to_thursday


def utc(day: Column, clock: Column) -> Column:
    """A New York wall time as a UTC wall time (timestamp without zone)."""
    local = F.concat_ws(" ", day.cast("string"), clock).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(NEW_YORK), F.lit("UTC"), local)


def new_york_date(instant: str) -> Column:
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), F.col(instant).cast("timestamp_ntz")))


def sessions(days: DataFrame, closures: Sequence[str] = CLOSURES) -> DataFrame:
    """(first_day, last_day) to one row a session: session_date, market_open, market_close (UTC), is_early_close."""
    d = F.col("session_date")
    each = days.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("session_date")).where((F.weekday(d) < 5) & ~is_holiday(d, closures))
    early = is_early_close(d)
    return each.select(d, utc(d, F.lit(OPEN)).alias("market_open"), utc(d, F.when(early, EARLY_CLOSE).otherwise(CLOSE)).alias("market_close"), early.alias("is_early_close"))


def held(sess: DataFrame, most: int = 100_000) -> DataFrame:
    """The calendar as a local table (a row a session, some 250 a year), so that no plan carries its rules to the rows it is
    joined with."""
    rows = sess.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a calendar of more than {most} sessions")
    return sess.sparkSession.createDataFrame(rows, sess.schema)


def session_grid(sess: DataFrame, symbols: Sequence[str] | None = None, minutes: int = BAR_MINUTES) -> DataFrame:
    """The bars of each session by their starts: 13, or 7 on an early close; for each symbol if a list is given."""
    width = F.expr(f"interval {minutes} minutes")
    grid = sess.select("session_date", F.explode(F.sequence("market_open", F.col("market_close") - width, width)).alias("window_start"))
    return grid if symbols is None else grid.select("*", F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"))


def future_bars(latest: DataFrame, sess: DataFrame, periods: int, minutes: int = BAR_MINUTES) -> DataFrame:
    """The next ``periods`` bar ends after each symbol's last one, closures skipped: symbol, step, event_timestamp.

    Ends are numbered once; how many of them lie at or before a symbol's last time follows from that time's day (a row a day says
    how many came before) and its distance from the day's opening, so symbols meet days and numbers by equality only."""
    width = F.expr(f"interval {minutes} minutes")

    def second(c: Column) -> Column:
        return F.unix_timestamp(c.cast("timestamp"))

    ends = sess.select(F.explode(F.sequence(F.col("market_open") + width, "market_close", width)).alias("event_timestamp"))
    numbered = ends.withColumn("_n", F.row_number().over(W.orderBy("event_timestamp")))  # a few thousand rows a year
    length = F.floor((second(F.col("market_close")) - second(F.col("market_open"))) / (60 * minutes))
    span = sess.agg(F.min("session_date").alias("_a"), F.max("session_date").alias("_b")).where("_a is not null")
    days = span.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("_day"))
    bars = sess.select(F.col("session_date").alias("_day"), F.col("market_open").alias("_open"), length.alias("_bars"))
    before = F.sum(F.coalesce("_bars", F.lit(0))).over(W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1))  # a row a day
    days = days.join(bars, "_day", "left").withColumn("_before", F.coalesce(before, F.lit(0)))
    last = latest.select("symbol", F.col("event_timestamp").alias("_last"), F.greatest(new_york_date("event_timestamp"), F.lit("0001-01-01").cast("date")).alias("_day"))
    inside = F.greatest(F.lit(0), F.least("_bars", F.floor((second(F.col("_last")) - second(F.col("_open"))) / (60 * minutes))))
    first = last.crossJoin(F.broadcast(span)).where("_day <= _b").withColumn("_day", F.greatest("_day", "_a"))  # one row
    first = first.join(F.broadcast(days), "_day").select("symbol", (F.col("_before") + F.coalesce(inside, F.lit(0))).alias("_done"))
    steps = first.select("symbol", F.posexplode(F.sequence(F.col("_done") + 1, F.col("_done") + periods)).alias("step", "_n"))
    return steps.join(F.broadcast(numbered), "_n").select("symbol", (F.col("step") + 1).alias("step"), "event_timestamp")


def session_at(instants: DataFrame, sess: DataFrame, instant: str = "instant", lead: str = "10 minutes") -> DataFrame:
    """``instants`` with is_open and may_collect (from ``lead`` before the opening to the close)."""
    s = F.broadcast(sess).alias("s")
    i = instants.withColumn("_day", new_york_date(instant))
    out = i.join(s, F.col("_day") == F.col("s.session_date"), "left")
    at = F.col(instant).cast("timestamp_ntz")
    is_open = F.coalesce((at >= F.col("s.market_open")) & (at < F.col("s.market_close")), F.lit(False))
    collect = F.coalesce((at >= F.col("s.market_open") - F.expr(f"interval {lead}")) & (at < F.col("s.market_close")), F.lit(False))
    return out.select(*instants.columns, is_open.alias("is_open"), collect.alias("may_collect"))


def freshness(cutoffs: DataFrame, sess: DataFrame, now: Column, delay: str = "60 minutes") -> DataFrame:
    """``cutoffs`` (cutoff) with required_close (the last close that is due) and status: fresh, future, off_session or stale."""
    due = sess.agg(F.max(F.when(F.col("market_close") + F.expr(f"interval {delay}") <= now, F.col("market_close"))).alias("required_close"))
    closes = F.broadcast(sess.select(F.col("market_close").alias("cutoff"), F.lit(True).alias("_close")))
    c = cutoffs.join(closes, "cutoff", "left").crossJoin(F.broadcast(due))  # one row
    status = F.when(F.col("cutoff") > now, "future").when(F.col("_close").isNull(), "off_session").when(F.col("cutoff") < F.col("required_close"), "stale").otherwise("fresh")
    return c.withColumn("status", F.when(F.col("required_close").isNull(), "stale").otherwise(status)).drop("_close")


def special_days(spark: SparkSession) -> DataFrame:
    """is_holiday and is_early_close of each day from 1900 to 2199, as the text of a number."""
    d = F.col("_of")
    days = spark.range(-25_567, 84_006).select(F.date_from_unix_date(F.col("id").cast("int")).alias("_of"))
    return days.select(d, is_holiday(d).cast("int").cast("double").cast("string").alias("is_holiday"), (is_early_close(d) & ~is_holiday(d)).cast("int").cast("double").cast("string").alias("is_early_close"))


def holiday_flags(df: DataFrame, instant: str) -> DataFrame:
    """is_holiday and is_early_close of the New York date, as the text of a number; null without an instant.

    The rules run once a day of the calendar and not once a row."""
    days = F.broadcast(special_days(df.sparkSession))  # 109,573 rows of two short strings
    kept = df.drop("is_holiday", "is_early_close")
    return kept.withColumn("_day", new_york_date(instant)).join(days, F.col("_day") == F.col("_of"), "left").select(*[kept[c] for c in kept.columns], days["is_holiday"], days["is_early_close"])
