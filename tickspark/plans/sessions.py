"""Calendar and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import calendar as C
from tickspark.operators import coverage as V
from tickspark.plans.common import BARS, SYMBOLS, TRADES, read, register, trades
from tickspark.plans.market import half_hours

LISTED = ", ".join(f"'{s}'" for s in SYMBOLS)

#: The exchange's full closures and early closes of 2023 to 2025, as the SQL's own calendar.
CLOSED = """2023-01-02 2023-01-16 2023-02-20 2023-04-07 2023-05-29 2023-06-19 2023-07-04 2023-09-04 2023-11-23 2023-12-25
2024-01-01 2024-01-15 2024-02-19 2024-03-29 2024-05-27 2024-06-19 2024-07-04 2024-09-02 2024-11-28 2024-12-25
2025-01-01 2025-01-09 2025-01-20 2025-02-17 2025-04-18 2025-05-26 2025-06-19 2025-07-04 2025-09-01 2025-11-27 2025-12-25""".split()
EARLY = "2023-07-03 2023-11-24 2024-07-03 2024-11-29 2024-12-24 2025-07-03 2025-11-28 2025-12-24".split()


def _dates(days: list[str]) -> str:
    return ", ".join(f"DATE '{x}'" for x in days)


def _utc(minutes: str) -> str:
    return f"((d + {minutes} * INTERVAL 1 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'"


def _new_york(instant: str) -> str:
    return f"(({instant} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE"


SESS = f"""sess AS (SELECT d::DATE AS session_date, {_utc("570")} AS market_open, {_utc(f"(CASE WHEN d::DATE IN ({_dates(EARLY)}) THEN 780 ELSE 960 END)")} AS market_close, d::DATE IN ({_dates(EARLY)}) AS is_early_close
  FROM (SELECT unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM events)
  WHERE isodow(d) <= 5 AND d::DATE NOT IN ({_dates(CLOSED)}))"""
GRID = f"""{SESS}, starts AS (SELECT session_date, unnest(generate_series(market_open, market_close - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) AS window_start FROM sess),
  grid AS (SELECT session_date, window_start, unnest([{LISTED}]) AS symbol FROM starts)"""
INSIDE = "inside AS (SELECT s.session_date, market_open, market_close, t.* FROM trades t JOIN sess s ON t.event_time >= market_open AND t.event_time < market_close)"


#: The calendar of ``sess`` by the exchange's rules and so for any year, for the two qualifications.
RULED = f"""days AS (SELECT d, year(d) AS y, month(d) AS m, day(d) AS n, isodow(d) AS w, (19 * (y % 19) + y // 100 - y // 400 - (y // 100 - (y // 100 + 8) // 25 + 1) // 3 + 15) % 30 AS h,
  (32 + 2 * (y // 100 % 4) + 2 * (y % 100 // 4) - h - y % 4) % 7 AS l, h + l - 7 * ((y % 19 + 11 * h + 22 * l) // 451) + 114 AS p, make_date(y, p // 31, p % 31 + 1) AS easter
  FROM (SELECT unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM events)),
open_days AS (SELECT d, m = 11 AND w = 5 AND n BETWEEN 23 AND 29 OR w <= 4 AND (m = 12 AND n = 24 OR m = 7 AND n = 3) AS early FROM days WHERE w <= 5 AND NOT (
  m = 1 AND (n = 1 OR n = 2 AND w = 1) OR m = 1 AND y >= 1998 AND w = 1 AND n BETWEEN 15 AND 21 OR m = 2 AND w = 1 AND n BETWEEN 15 AND 21 OR d::DATE = easter - 2 OR m = 5 AND w = 1 AND n >= 25
  OR m = 6 AND y >= 2022 AND (n = 19 OR n = 20 AND w = 1 OR n = 18 AND w = 5) OR m = 7 AND (n = 4 OR n = 5 AND w = 1 OR n = 3 AND w = 5) OR m = 9 AND w = 1 AND n <= 7 OR m = 11 AND w = 4 AND n BETWEEN 22 AND 28
  OR m = 12 AND (n = 25 OR n = 26 AND w = 1 OR n = 24 AND w = 5) OR d::DATE IN ({_dates(C.CLOSURES)}))),
sess AS (SELECT d::DATE AS session_date, {_utc("570")} AS market_open, {_utc("(CASE WHEN early THEN 780 ELSE 960 END)")} AS market_close, early AS is_early_close FROM open_days)"""


def sess(spark, d):
    span = trades(spark, d).agg(F.min(F.to_date("event_time")).alias("first_day"), F.max(F.to_date("event_time")).alias("last_day"))
    return C.held(C.sessions(span))


@register("sessions", f"WITH {SESS} SELECT * FROM sess")
def sessions(spark, d):
    return sess(spark, d)


@register("session_grid", f"WITH {GRID} SELECT session_date, window_start, symbol FROM grid")
def session_grid(spark, d):
    return C.session_grid(sess(spark, d), SYMBOLS)


@register("holiday_flags", f"WITH {TRADES} SELECT event_id, CASE WHEN {_new_york('event_time')} IN ({_dates(CLOSED)}) THEN '1.0' ELSE '0.0' END AS is_holiday, CASE WHEN {_new_york('event_time')} IN ({_dates(EARLY)}) THEN '1.0' ELSE '0.0' END AS is_early_close FROM trades")
def holiday_flags(spark, d):
    return C.holiday_flags(trades(spark, d).select("event_id", "event_time"), "event_time").drop("event_time")


@register("session_state", f"WITH {TRADES}, {SESS} SELECT event_id, coalesce(event_time >= market_open AND event_time < market_close, FALSE) AS is_open, coalesce(event_time >= market_open - INTERVAL 10 MINUTE AND event_time < market_close, FALSE) AS may_collect FROM trades LEFT JOIN sess ON session_date = {_new_york('event_time')}")
def session_state(spark, d):
    return C.session_at(trades(spark, d).select("event_id", "event_time"), sess(spark, d), "event_time").select("event_id", "is_open", "may_collect")


CUTS = """cuts AS (SELECT DISTINCT date_trunc('hour', ts) AS cutoff FROM events WHERE hour(ts) IN (15, 21))"""


@register(
    "freshness_status",
    f"""WITH {SESS}, {CUTS}, due AS (SELECT max(market_close) AS required_close FROM sess WHERE market_close + INTERVAL 60 MINUTE <= TIMESTAMP '2024-01-25 21:30:00')
SELECT cutoff, required_close, CASE WHEN cutoff > TIMESTAMP '2024-01-25 21:30:00' THEN 'future' WHEN cutoff NOT IN (SELECT market_close FROM sess) THEN 'off_session' WHEN cutoff < required_close THEN 'stale' ELSE 'fresh' END AS status FROM cuts, due""",
)
def freshness_status(spark, d):
    t = trades(spark, d).where(F.hour("event_time").isin(15, 21)).select(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("cutoff")).distinct()
    return C.freshness(t, sess(spark, d), F.lit("2024-01-25 21:30:00").cast("timestamp_ntz"))


@register("publication_deadline", f"WITH {SESS}, {TRADES} SELECT symbol, max(event_time) AS latest, (SELECT max(market_close) FROM sess) AS required_close, max(event_time) >= (SELECT max(market_close) FROM sess) AS met FROM trades GROUP BY symbol")
def publication_deadline(spark, d):
    from tickspark.operators.release import deadline

    latest = trades(spark, d).groupBy("symbol").agg(F.max("event_time").alias("latest"))
    return deadline(latest, sess(spark, d), F.lit("2024-03-01").cast("timestamp_ntz"))


@register(
    "future_bars",
    f"""WITH {GRID}, {BARS}, l AS (SELECT symbol, max(window_end) AS last FROM bars WHERE window_end <= TIMESTAMP '2024-01-12 18:00:00' GROUP BY symbol), e AS (SELECT window_start + INTERVAL 30 MINUTE AS event_timestamp FROM starts),
n AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY event_timestamp)::INTEGER AS step, event_timestamp FROM l JOIN e ON event_timestamp > last) SELECT * FROM n WHERE step <= 39""",
)
def future_bars(spark, d):
    b = half_hours(spark, d).where(F.col("window_end") <= F.lit("2024-01-12 18:00:00").cast("timestamp_ntz"))
    return C.future_bars(b.groupBy("symbol").agg(F.max("window_end").alias("event_timestamp")), sess(spark, d), 39)


@register(
    "tick_coverage",
    f"""WITH {TRADES}, {SESS}, {INSIDE}, g AS (SELECT *, timestamp - lag(timestamp) OVER (PARTITION BY session_date, symbol ORDER BY timestamp) AS gap FROM inside),
a AS (SELECT session_date, symbol, count(*) AS trades, min(timestamp) AS first_ms, max(timestamp) AS last_ms, greatest(max(gap), min(timestamp) - epoch_us(any_value(market_open)) // 1000, epoch_us(any_value(market_close)) // 1000 - max(timestamp)) / 1000.0::DOUBLE AS max_gap_seconds,
  count(*) FILTER (price <= 0 OR volume <= 0) AS invalid FROM g GROUP BY session_date, symbol) SELECT *, max_gap_seconds <= 120 AND invalid = 0 AS passed FROM a""",
)
def tick_coverage(spark, d):
    return V.tick_coverage(trades(spark, d), sess(spark, d))


@register(
    "trade_gaps",
    f"""WITH {TRADES}, {SESS}, {INSIDE}, m AS (SELECT session_date, unnest([{LISTED}]) AS symbol, market_open, market_close FROM sess),
u AS (SELECT session_date, symbol, timestamp AS ms FROM inside UNION ALL SELECT session_date, symbol, epoch_us(market_open) // 1000 FROM m UNION ALL SELECT session_date, symbol, epoch_us(market_close) // 1000 FROM m),
g AS (SELECT *, lag(ms) OVER (PARTITION BY session_date, symbol ORDER BY ms) AS start_ms FROM u) SELECT session_date, symbol, start_ms, ms AS end_ms, (ms - start_ms) / 1000.0::DOUBLE AS seconds FROM g WHERE ms - start_ms > 120000""",
)
def trade_gaps(spark, d):
    return V.trade_gaps(trades(spark, d), sess(spark, d), SYMBOLS)


@register("missing_bars", f"WITH {GRID}, {BARS} SELECT g.session_date, g.symbol, g.window_start FROM grid g ANTI JOIN bars b USING (symbol, window_start)")
def missing_bars(spark, d):
    return V.missing_bars(half_hours(spark, d), sess(spark, d), SYMBOLS)


@register(
    "interior_gaps",
    f"""WITH {GRID}, {BARS}, s AS (SELECT session_date, symbol, min(window_start) AS a, max(window_start) AS b FROM bars JOIN grid USING (symbol, window_start) GROUP BY ALL)
SELECT g.session_date, g.symbol, g.window_start FROM grid g JOIN s ON g.symbol = s.symbol AND g.session_date = s.session_date AND g.window_start BETWEEN a AND b ANTI JOIN bars ON bars.symbol = g.symbol AND bars.window_start = g.window_start""",
)
def interior_gaps(spark, d):
    return V.interior_gaps(half_hours(spark, d), sess(spark, d))


#: Half-hour bars with trades of one instant in the order of their ids; a null price counts if it comes first or last.
ORDERED = f"""{TRADES}, bars AS (SELECT time_bucket(INTERVAL 30 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 30 MINUTE, event_time) + INTERVAL 30 MINUTE AS window_end, symbol,
  first(price ORDER BY event_time, event_id NULLS FIRST) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY event_time, event_id NULLS FIRST) AS close, sum(volume)::BIGINT AS total_volume
  FROM trades WHERE event_time IS NOT NULL GROUP BY ALL)"""
BAD = " OR ".join(f"{c} IS NULL OR NOT isfinite({c}::DOUBLE) OR {c} <= 0" for c in ("open", "high", "low", "close", "total_volume"))
EVIDENCE = f"""WITH {GRID.replace(SESS, RULED)}, {ORDERED}, seen AS (SELECT s.session_date, b.symbol, count(*) AS n, count(DISTINCT window_start) AS observed, count(*) FILTER ((epoch_ms(window_start) - epoch_ms(market_open)) % 1800000 <> 0) AS off_grid,
  count(*) FILTER ({BAD}) AS invalid, count(*) FILTER (high < greatest(open, close, low) OR low > least(open, close, high)) AS bad_bounds, count(*) FILTER (epoch_ms(window_end) - epoch_ms(window_start) <> 1800000) AS bad_width
  FROM bars b JOIN sess s ON b.window_start >= market_open AND b.window_start < market_close GROUP BY ALL),
ex AS (SELECT session_date, symbol, count(*) AS expected FROM grid GROUP BY ALL),
e AS (SELECT ex.session_date, ex.symbol, expected, coalesce(observed, 0) AS observed, coalesce(off_grid, 0) AS off_grid, coalesce(invalid, 0) AS invalid, coalesce(bad_bounds, 0) AS bad_bounds, coalesce(bad_width, 0) AS bad_width, coalesce(n - observed, 0) AS duplicates
  FROM ex LEFT JOIN seen ON ex.session_date = seen.session_date AND ex.symbol = seen.symbol),
ev AS (SELECT *, observed = expected AND duplicates + off_grid + invalid + bad_bounds + bad_width = 0 AS passed FROM e)"""


def ordered_bars(spark, d):
    """Half-hour bars whose open and close don't hang on chance where trades share an instant."""
    return B.ohlcv(trades(spark, d), sequence="event_id")


@register("session_qualification", f"{EVIDENCE} SELECT * FROM ev")
def session_qualification(spark, d):
    return V.qualify_sessions(ordered_bars(spark, d), sess(spark, d), SYMBOLS)


@register(
    "historical_qualification",
    f"""{EVIDENCE}, h AS (SELECT symbol, count(*) AS sessions, count(*) FILTER (passed) AS qualified, sum(expected - least(expected, observed - off_grid))::BIGINT AS missing FROM ev GROUP BY symbol),
o AS (SELECT symbol, count(*) AS off FROM bars ANTI JOIN grid USING (symbol, window_start) GROUP BY symbol),
t AS (SELECT symbol, sum(n - 1)::BIGINT AS twice FROM (SELECT symbol, window_start, count(*) AS n FROM bars GROUP BY symbol, window_start) GROUP BY symbol),
a AS (SELECT symbol, sessions, qualified, missing, coalesce(off, 0) AS off_session, coalesce(twice, 0) AS duplicates FROM h LEFT JOIN o USING (symbol) LEFT JOIN t USING (symbol))
SELECT *, sessions = qualified AND off_session + duplicates = 0 AS passed FROM a""",
)
def historical_qualification(spark, d):
    return V.qualify_history(ordered_bars(spark, d), sess(spark, d), SYMBOLS)


@register(
    "recovery_coverage",
    f"""WITH {TRADES}, {GRID}, {INSIDE}, h AS (SELECT session_date, symbol, time_bucket(INTERVAL 30 MINUTE, event_time) AS window_start, count(*) AS n, min(event_time) AS a, max(event_time) AS b FROM inside GROUP BY ALL)
SELECT g.session_date, g.symbol, count(*) AS expected, count(n) AS observed, coalesce(string_agg(CASE WHEN n IS NULL THEN strftime(g.window_start, '%H:%M') END, ',' ORDER BY g.window_start), '') AS missing, coalesce(sum(n), 0)::BIGINT AS trades, min(a) AS first, max(b) AS last
FROM grid g LEFT JOIN h ON g.session_date = h.session_date AND g.symbol = h.symbol AND g.window_start = h.window_start GROUP BY g.session_date, g.symbol""",
)
def recovery_coverage(spark, d):
    return V.recovery_coverage(trades(spark, d), sess(spark, d), SYMBOLS)


ROW_HASH = """sha256('{"symbol":"' || symbol || '","window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.000') || '","window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S.000')
  || '","open":' || open || ',"high":' || high || ',"low":' || low || ',"close":' || close || ',"total_volume":' || total_volume || '}')"""


@register(
    "content_digest",
    f"""WITH {BARS}, h AS (SELECT symbol, window_start::DATE AS day, {ROW_HASH} AS h FROM bars),
g AS (SELECT sha256(symbol || '|' || day) AS p, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY symbol, day),
l6 AS (SELECT left(p, 6) AS p, sha256(string_agg(p || ':' || d, '' ORDER BY p || ':' || d)) AS d FROM g GROUP BY 1), l4 AS (SELECT left(p, 4) AS p, sha256(string_agg(p || ':' || d, '' ORDER BY p || ':' || d)) AS d FROM l6 GROUP BY 1),
l2 AS (SELECT left(p, 2) AS p, sha256(string_agg(p || ':' || d, '' ORDER BY p || ':' || d)) AS d FROM l4 GROUP BY 1)
SELECT (SELECT count(*) FROM g) AS groups, sha256(string_agg(p || ':' || d, '' ORDER BY p || ':' || d)) AS digest FROM l2""",
)
def content_digest(spark, d):
    return V.content_digest(half_hours(spark, d))


@register(
    "release_differences",
    f"""WITH {BARS}, other AS (SELECT * REPLACE (CASE WHEN symbol = 'view' AND day(window_start) % 5 = 0 AND hour(window_start) = 7 THEN close + 1 ELSE close END AS close) FROM bars WHERE NOT (symbol = 'click' AND day(window_start) % 9 = 0) AND NOT (symbol = 'error' AND day(window_start) % 7 = 0 AND hour(window_start) = 20)),
a AS (SELECT symbol, window_start::DATE AS day, list(close ORDER BY window_start) AS v FROM bars GROUP BY ALL), b AS (SELECT symbol, window_start::DATE AS day, list(close ORDER BY window_start) AS v FROM other GROUP BY ALL)
SELECT symbol, day, CASE WHEN b.v IS NULL THEN 'left' WHEN a.v IS NULL THEN 'right' ELSE 'changed' END AS side FROM a FULL JOIN b USING (symbol, day) WHERE a.v IS DISTINCT FROM b.v""",
)
def release_differences(spark, d):
    """A release against one with some prices changed, a symbol's days and some bars missing: found down two hash trees."""
    b, day, hour = half_hours(spark, d), F.dayofmonth("window_start"), F.hour("window_start")
    gone = (F.col("symbol") == "click") & (day % 9 == 0) | (F.col("symbol") == "error") & (day % 7 == 0) & (hour == 20)
    moved = (F.col("symbol") == "view") & (day % 5 == 0) & (hour == 7)
    other = b.where(~gone).withColumn("close", F.when(moved, F.col("close") + 1).otherwise(F.col("close")))
    return V.differences(V.digest_tree(b), V.digest_tree(other))


@register("request_guards", """WITH q AS (SELECT o_orderkey, o_orderdate::DATE AS start_date, (o_orderdate::DATE + (o_orderkey % 900)::INTEGER) - 100 AS end_date FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN end_date < start_date THEN 'dates_out_of_order' END, CASE WHEN end_date - start_date > 730 THEN 'range_too_long' END, CASE WHEN DATE '1998-01-01' < end_date THEN 'unfinished_range' END], lambda x: x IS NOT NULL), ',') AS refused FROM q""")
def request_guards(spark, d):
    o = read(spark, d, "orders").withColumn("start_date", F.to_date("o_orderdate"))
    q = o.select("o_orderkey", "start_date", F.date_add("start_date", (F.col("o_orderkey") % 900 - 100).cast("int")).alias("end_date"), F.lit("1998-01-01").cast("date").alias("retrieved_at"))
    return V.request_guards(q).select("o_orderkey", F.array_join("refused", ",").alias("refused"))


@register("snapshot_freshness", f"WITH {BARS} SELECT max(window_end) AS newest, epoch_us(TIMESTAMP '2024-02-02 00:00:00' - max(window_end)) / 1000000.0::DOUBLE AS staleness_seconds FROM bars".replace("epoch_us(TIMESTAMP '2024-02-02 00:00:00' - max(window_end))", "(epoch_us(TIMESTAMP '2024-02-02 00:00:00') - epoch_us(max(window_end)))"))
def snapshot_freshness(spark, d):
    from tickspark.operators.monitoring import snapshot_freshness as fresh

    return fresh(half_hours(spark, d), F.lit("2024-02-02").cast("timestamp_ntz"), "window_end")


@register("allowed_symbols", f"WITH {TRADES} SELECT event_id, 'CLICK' AS symbol FROM trades WHERE symbol = 'click'")
def allowed_symbols(spark, d):
    from tickspark.operators.quality import allow_symbols

    return allow_symbols(trades(spark, d).select("event_id", F.concat(F.lit(" "), "symbol").alias("symbol")), ["Click "])


@register(
    "prediction_frame",
    f"""WITH {GRID}, {BARS}, h AS (SELECT symbol, window_end AS event_timestamp, close, total_volume FROM bars WHERE window_end <= TIMESTAMP '2024-01-12 18:00:00'), l AS (SELECT symbol, max(event_timestamp) AS last, arg_max(close, event_timestamp) AS close, arg_max(total_volume, event_timestamp) AS total_volume FROM h GROUP BY symbol),
n AS (SELECT symbol, close, total_volume, window_start + INTERVAL 30 MINUTE AS event_timestamp, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS k FROM l JOIN starts ON window_start + INTERVAL 30 MINUTE > last),
u AS (SELECT symbol, event_timestamp, close, total_volume FROM h UNION ALL SELECT symbol, event_timestamp, close, total_volume FROM n WHERE k <= 39)
SELECT symbol, event_timestamp, row_number() OVER w::INTEGER - 1 AS time_idx, CASE WHEN {_new_york('event_timestamp')} IN ({_dates(CLOSED)}) THEN '1.0' ELSE '0.0' END AS is_holiday, hour(event_timestamp)::INTEGER AS hour, round(ln(close), 8) AS log_close,
  round(coalesce(ln(close) - lag(ln(close)) OVER w, 0), 8) + 0.0 AS target FROM u WINDOW w AS (PARTITION BY symbol ORDER BY event_timestamp)""".replace("row_number() OVER w::INTEGER", "(row_number() OVER w)::INTEGER"),
)
def prediction_frame(spark, d):
    from tickspark.operators.training import prediction_frame as frame

    b = half_hours(spark, d).where(F.col("window_end") <= F.lit("2024-01-12 18:00:00").cast("timestamp_ntz")).select("symbol", F.col("window_end").alias("event_timestamp"), "close", "total_volume")
    latest = b.groupBy("symbol").agg(F.max("event_timestamp").alias("event_timestamp"))
    out = frame(b, C.future_bars(latest, sess(spark, d), 39))
    return out.select("symbol", "event_timestamp", "time_idx", "is_holiday", "hour", F.round("log_close", 8).alias("log_close"), (F.round("target", 8) + 0.0).alias("target"))
