"""Trades, quality, bars and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.operators import bars as B
from tickspark.operators import quality as Q
from tickspark.plans.common import AS_OF, BARS, FAULTY, GAPPY, SYMBOLS, TRADES, faulty, register, trades
from tickspark.sources import trades as T


def moment():
    return F.lit(AS_OF).cast("timestamp_ntz")


def half_hours(spark, d):
    return B.ohlcv(trades(spark, d))


def featured(spark, d):
    return B.rolling(half_hours(spark, d))


def gappy(spark, d):
    slot = F.floor((F.minute("window_start") + F.hour("window_start") * 60) / 30)
    b = half_hours(spark, d)
    return b.select(
        "symbol", "window_start", "window_end", "high", "low", F.when(slot % 7 != 3, F.col("close")).alias("close"),
        F.when((F.col("symbol") != "error") & (F.hour("window_start") != 0), F.col("open")).alias("open"),
    )


@register("trades_decoded", f"WITH {TRADES} SELECT event_id, symbol, price, volume::DOUBLE AS volume, timestamp, epoch_us(event_time) // 1000 AS event_ms FROM trades")
def trades_decoded(spark, d):
    wire = trades(spark, d).select("event_id", F.to_json(F.struct("symbol", "price", "volume", "timestamp")).cast("binary").alias("value"))
    parsed = F.from_json(F.col("value").cast("string"), T.RAW_TRADE)
    rows = wire.select("event_id", parsed.alias("_t")).select("event_id", "_t.*")
    return rows.withColumn("event_ms", F.unix_millis(T.millis(F.col("timestamp"))))


REASONS = """CASE WHEN r = '' THEN NULL ELSE r END AS dq_reason FROM (SELECT *, concat_ws(';', CASE WHEN symbol IS NULL OR trim(symbol) = '' THEN 'missing_symbol' END,
  CASE WHEN price IS NULL OR price <= 0 THEN 'invalid_price' END, CASE WHEN volume IS NULL OR volume < 0 THEN 'invalid_volume' END,
  CASE WHEN timestamp IS NULL OR timestamp <= 0 THEN 'invalid_timestamp' END, CASE WHEN event_time IS NULL THEN 'invalid_event_time' END,
  CASE WHEN event_time < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 MINUTE THEN 'late_event' END) AS r FROM faulty)"""
TAGGED = f"WITH {FAULTY}, tagged AS (SELECT event_id, symbol, price, volume, timestamp, event_time, {REASONS})"


@register("trades_valid", f"{TAGGED} SELECT event_id, symbol, price, volume, timestamp, event_time FROM tagged WHERE dq_reason IS NULL")
def trades_valid(spark, d):
    return Q.split(faulty(spark, d), moment())[0]


@register("trades_dead_letter", f"{TAGGED} SELECT event_id, symbol, price, volume, timestamp, event_time, dq_reason, TIMESTAMP '2024-01-20 00:00:00' AS ingested_at FROM tagged WHERE dq_reason IS NOT NULL")
def trades_dead_letter(spark, d):
    return Q.split(faulty(spark, d), moment())[1]


@register("dead_letter_counts", f"{TAGGED} SELECT dq_reason, count(*) AS n FROM tagged WHERE dq_reason IS NOT NULL GROUP BY 1")
def dead_letter_counts(spark, d):
    return Q.reason_counts(Q.split(faulty(spark, d), moment())[1])


@register("late_events", f"WITH {TRADES} SELECT event_id, symbol, event_time FROM trades WHERE event_time < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 MINUTE")
def late_events(spark, d):
    return trades(spark, d).where(Q.is_late(moment())).select("event_id", "symbol", "event_time")


@register("strict_trades", f"""WITH {FAULTY} SELECT event_id, coalesce(symbol IN ('click', 'purchase', 'view') AND price > 0 AND volume > 0 AND timestamp >= 1000000000000 AND timestamp < 100000000000000, FALSE) AS valid FROM faulty""")
def strict_trades(spark, d):
    return Q.strict_trades(faulty(spark, d), ["click", "purchase", "view"]).select("event_id", "valid")


@register(
    "normalized_trades",
    f"""WITH {FAULTY}, m AS (SELECT event_id AS message_id, 0 AS position, upper(trim(symbol)) AS symbol, price, volume::DOUBLE AS volume, timestamp FROM faulty)
SELECT message_id, position, symbol, price, volume, timestamp FROM m WHERE symbol IN ('CLICK', 'PURCHASE', 'SIGNUP', 'VIEW', 'ERROR') AND price > 0 AND volume > 0 AND timestamp IS NOT NULL""",
)
def normalized_trades(spark, d):
    t = faulty(spark, d)
    short, odd = F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1
    item = F.struct(
        F.when(short, F.col("symbol")).alias("s"), F.when(odd, F.lower("symbol")).alias("symbol"), F.when(short, F.col("price")).otherwise(F.lit(0.0)).alias("p"), F.when(odd, F.col("price")).alias("price"),
        F.when(short, F.col("volume")).alias("v"), F.when(odd, F.col("volume")).alias("size"), F.when(short, F.col("timestamp")).alias("t"), F.when(odd, F.col("timestamp")).alias("timestamp"),
    )
    return T.normalise(t.select(F.col("event_id").alias("message_id"), F.array(item).alias("data")), [s.upper() for s in SYMBOLS])


@register(
    "consumer_latency",
    f"""WITH {TRADES} SELECT event_id AS record_id, CASE WHEN event_id % 10 = 0 THEN 'key' ELSE symbol END AS symbol, CASE WHEN event_id % 11 <> 0 THEN price END AS price, volume::DOUBLE AS volume, timestamp,
  timestamp + 250 AS consumed_at, timestamp + event_id % 200 AS produced_at, 250 - event_id % 200 AS end_to_end_latency_ms, 250::BIGINT AS market_latency_ms FROM trades""",
)
def consumer_latency(spark, d):
    k = F.col("event_id")
    body = F.struct(F.when(k % 10 != 0, F.col("symbol")).otherwise(" ").alias("symbol"), F.when(k % 11 != 0, F.col("price").cast("string")).otherwise("n/a").alias("price"), F.col("volume").cast("string").alias("volume"), F.col("timestamp").cast("string").alias("timestamp"))
    r = trades(spark, d).select(k.alias("record_id"), F.lit("key").alias("key"), F.to_json(body).alias("value"), (F.col("timestamp") + 250).alias("consumed_at"), (F.col("timestamp") + k % 200).alias("produced_at"))
    return T.consumed(r)


@register(
    "ingestion_health",
    f"""WITH {FAULTY} SELECT count(*) AS messages, count(*) FILTER (price IS NULL OR price <= 0) AS errors, round(count(*) FILTER (price IS NULL OR price <= 0) * 100.0 / count(*), 6)::DOUBLE AS error_pct,
  count(DISTINCT nullif(trim(symbol), '')) AS symbols, max(event_id) AS last_offset, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') // 1000 - epoch_us(max(event_time)) // 1000) / 1000.0::DOUBLE) AS age_seconds FROM (SELECT *, 0 AS x FROM faulty) GROUP BY x""",
)
def ingestion_health(spark, d):
    from tickspark.operators import monitoring

    return monitoring.ingestion_health(faulty(spark, d).withColumn("offset", F.col("event_id")), F.lit("2024-02-01").cast("timestamp_ntz"))


@register("duplicate_payloads", f"WITH {TRADES}, t AS (SELECT symbol, timestamp // 60000 AS timestamp, floor(price / 50) AS price, volume % 3 AS volume FROM trades), g AS (SELECT symbol, count(*) AS n FROM t GROUP BY symbol, timestamp, price, volume) SELECT symbol, sum(n)::BIGINT AS trades, sum(n - 1)::BIGINT AS identical FROM g GROUP BY symbol")
def duplicate_payloads(spark, d):
    t = trades(spark, d).select("symbol", F.floor(F.col("timestamp") / 60000).alias("timestamp"), F.floor(F.col("price") / 50).alias("price"), (F.col("volume") % 3).alias("volume"))
    return Q.duplicate_payloads(t)


@register("ohlcv_30m", f"WITH {BARS} SELECT * FROM bars")
def ohlcv_30m(spark, d):
    return half_hours(spark, d)


@register(
    "ohlcv_resample_2h",
    f"""WITH {BARS} SELECT time_bucket(INTERVAL 2 HOUR, window_start) AS window_start, time_bucket(INTERVAL 2 HOUR, window_start) + INTERVAL 2 HOUR AS window_end, symbol, arg_min(open, b.window_start) AS open, max(high) AS high, min(low) AS low,
  arg_max(close, b.window_start) AS close, sum(total_volume)::BIGINT AS total_volume FROM bars b GROUP BY time_bucket(INTERVAL 2 HOUR, b.window_start), symbol""".replace("time_bucket(INTERVAL 2 HOUR, window_start)", "time_bucket(INTERVAL 2 HOUR, b.window_start)"),
)
def ohlcv_resample_2h(spark, d):
    return B.resample(half_hours(spark, d), "2 hours")


ROLLING = f"""WITH {BARS}, f AS (SELECT *, round(avg(close) OVER w, 8) AS rolling_avg_close, round(stddev_samp(close) OVER w, 8) AS rolling_volatility_close, lag(close) OVER s AS p FROM bars
  WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW), s AS (PARTITION BY symbol ORDER BY window_start))"""


def rounded(df, *cols, digits=8):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@register("rolling_features", f"{ROLLING} SELECT window_start, window_end, symbol, open, high, low, close, total_volume, rolling_avg_close, rolling_volatility_close FROM f")
def rolling_features(spark, d):
    return rounded(B.rolling(half_hours(spark, d), ("avg_close", "volatility_close")), "rolling_avg_close", "rolling_volatility_close")


@register("returns", f"{ROLLING} SELECT window_start, symbol, round((close - p) / p, 8) AS returns, round(ln(close) - ln(p), 8) AS log_returns FROM f")
def returns(spark, d):
    return rounded(B.rolling(half_hours(spark, d), ("returns", "log_returns")), "returns", "log_returns").select("window_start", "symbol", "returns", "log_returns")


@register(
    "bounded_history",
    f"""WITH {BARS}, p AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS r FROM bars WHERE window_start < TIMESTAMP '2024-01-20 00:00:00')
SELECT window_start, window_end, symbol, open, high, low, close, total_volume FROM p WHERE r <= 60 UNION ALL SELECT * FROM bars WHERE window_start >= TIMESTAMP '2024-01-20 00:00:00' AND window_start < TIMESTAMP '2024-01-20 06:30:00'""",
)
def bounded_history(spark, d):
    return B.bounded_history(half_hours(spark, d), moment(), moment() + F.expr("interval 390 minutes"))


@register("time_index", f"WITH {BARS} SELECT symbol, window_start, row_number() OVER (PARTITION BY symbol ORDER BY window_start)::INTEGER - 1 AS time_idx FROM bars")
def time_index(spark, d):
    return B.time_index(half_hours(spark, d)).select("symbol", "window_start", "time_idx")


@register("dedupe_latest", f"WITH {TRADES} SELECT symbol, date_trunc('hour', event_time) AS hour, arg_max(event_id, event_time) AS event_id, arg_max(price, event_time) AS price FROM trades GROUP BY ALL")
def dedupe_latest(spark, d):
    t = trades(spark, d).withColumn("hour", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))
    return B.dedupe_latest(t, ["symbol", "hour"], F.desc("event_time"), F.desc("event_id")).select("symbol", "hour", "event_id", "price")


@register("log_return_target", f"{ROLLING} SELECT symbol, window_start, round(ln(close) - ln(p), 8) AS target FROM f WHERE p IS NOT NULL")
def log_return_target(spark, d):
    return rounded(B.log_return_target(half_hours(spark, d)), "target").select("symbol", "window_start", "target")


FILLED = """last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY window_start), first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
IMPUTED = f"WITH {GAPPY}, filled AS (SELECT symbol, window_start, coalesce({FILLED.format(c='open')}) AS open, coalesce({FILLED.format(c='close')}) AS close FROM gappy)"


@register("imputed_symbol", f"{IMPUTED} SELECT * FROM filled")
def imputed_symbol(spark, d):
    return Q.impute(gappy(spark, d), ["open", "close"], order="window_start").select("symbol", "window_start", "open", "close")


@register(
    "imputed_global",
    f"""WITH {GAPPY} SELECT symbol, window_start, coalesce(last_value(open IGNORE NULLS) OVER p, first_value(open IGNORE NULLS) OVER a) AS open, coalesce(last_value(close IGNORE NULLS) OVER p, first_value(close IGNORE NULLS) OVER a) AS close
FROM gappy WINDOW p AS (PARTITION BY symbol ORDER BY window_start), a AS (ORDER BY symbol, window_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def imputed_global(spark, d):
    return Q.impute(gappy(spark, d), ["open", "close"], order="window_start", backfill="global").select("symbol", "window_start", "open", "close")


@register(
    "imputation_stats",
    f"""{IMPUTED}, n AS (SELECT 'open' AS "column", (SELECT count(*) FROM gappy WHERE open IS NULL) AS nulls_before, (SELECT count(*) FROM filled WHERE open IS NULL) AS nulls_after, (SELECT count(*) FROM gappy) AS n
  UNION ALL SELECT 'close', (SELECT count(*) FROM gappy WHERE close IS NULL), (SELECT count(*) FROM filled WHERE close IS NULL), (SELECT count(*) FROM gappy))
SELECT "column", nulls_before, nulls_after, CASE WHEN nulls_before = 0 THEN 100.0 ELSE round((nulls_before - nulls_after) * 100.0::DOUBLE / nulls_before, 6) END AS fixed_pct, round(nulls_after * 100.0::DOUBLE / n, 6) AS residual_pct FROM n""",
)
def imputation_stats(spark, d):
    g = gappy(spark, d)
    return Q.imputation_stats(g, Q.impute(g, ["open", "close"], order="window_start"), ["open", "close"])


BROKEN = f"""{ROLLING}, fr AS (SELECT symbol, window_start, window_end, CASE WHEN k % 31 = 0 THEN window_start ELSE window_end END AS event_timestamp, open, CASE WHEN k % 17 = 0 THEN low - 1 ELSE high END AS high, low, CASE WHEN k % 23 = 0 THEN -close ELSE close END AS close,
  CASE WHEN k % 19 = 0 THEN 0.5 ELSE total_volume::DOUBLE END AS total_volume, rolling_avg_close, rolling_volatility_close FROM (SELECT *, (epoch(window_start) // 1800)::BIGINT % 1000 AS k FROM f))"""


def broken(spark, d):
    k = F.floor(F.unix_timestamp(F.col("window_start").cast("timestamp")) / 1800) % 1000
    f = rolling_features(spark, d).withColumn("k", k)
    return f.select(
        "symbol", "window_start", "window_end", F.when(F.col("k") % 31 == 0, F.col("window_start")).otherwise(F.col("window_end")).alias("event_timestamp"), "open", F.when(F.col("k") % 17 == 0, F.col("low") - 1).otherwise(F.col("high")).alias("high"), "low",
        F.when(F.col("k") % 23 == 0, -F.col("close")).otherwise(F.col("close")).alias("close"), F.when(F.col("k") % 19 == 0, 0.5).otherwise(F.col("total_volume").cast("double")).alias("total_volume"), "rolling_avg_close", "rolling_volatility_close",
    )


RULE_SQL = {
    "null_value": "symbol IS NULL OR window_start IS NULL OR window_end IS NULL OR event_timestamp IS NULL OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR total_volume IS NULL OR rolling_avg_close IS NULL OR rolling_volatility_close IS NULL",
    "non_finite": "NOT isfinite(open) OR NOT isfinite(high) OR NOT isfinite(low) OR NOT isfinite(close) OR NOT isfinite(total_volume) OR NOT isfinite(rolling_avg_close) OR NOT isfinite(rolling_volatility_close)",
    "price_not_positive": "open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR rolling_avg_close <= 0",
    "negative_volume_or_volatility": "total_volume < 0 OR rolling_volatility_close < 0",
    "volume_not_bigint": "total_volume % 1 <> 0",
    "ohlc_bounds": "high < greatest(open, close, low) OR low > least(open, close, high)",
    "window_order": "window_start >= window_end",
    "event_time_not_window_end": "event_timestamp <> window_end",
}


@register("frame_violations", f"{BROKEN} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER ({c}) AS violations FROM fr" for n, c in RULE_SQL.items()) + " UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT (symbol, window_start)) FROM fr")
def frame_violations(spark, d):
    return Q.violation_counts(broken(spark, d), Q.frame_rules())


@register("expectation_results", f"WITH {FAULTY} SELECT * FROM (VALUES ('exists:price', 0::BIGINT), ('exists:symbol', 0), ('exists:volume', 0), ('type:price', 0), ('type:volume', 1)) v(expectation, failures) UNION ALL SELECT 'not_null:symbol', count(*) FILTER (symbol IS NULL) FROM faulty UNION ALL SELECT 'not_null:price', count(*) FILTER (price IS NULL) FROM faulty")
def expectation_results(spark, d):
    return Q.expectations(faulty(spark, d), ["symbol", "price"], {"price": "float", "volume": "float"})


@register("contract_violations", "SELECT 'missing' AS violation, 'event_ts' AS \"column\", (SELECT count(*) FROM events) AS rows UNION ALL SELECT 'expected float, got bigint', 'volume', (SELECT count(*) FROM events)")
def contract_violations(spark, d):
    t = trades(spark, d)
    found = Q.contract_violations(t, {"symbol": "string", "volume": "float", "event_ts": "datetime"})
    return t.agg(F.count("*").alias("rows")).select(F.inline(F.array(*[F.struct(F.lit(v).alias("violation"), F.lit(c).alias("column")) for c, v in found])), "rows")


@register("zscore_outliers", f"WITH {TRADES}, z AS (SELECT event_id, symbol, price, (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS z FROM trades) SELECT event_id, symbol, price, round(z, 6) AS z FROM z WHERE abs(z) > 3.0")
def zscore_outliers(spark, d):
    return rounded(Q.outliers(trades(spark, d).select("event_id", "symbol", "price"), "price"), "z", digits=6)


@register(
    "candle_arrays_to_bars",
    f"""WITH {BARS} SELECT symbol, window_start, window_end, open, high, low, close, total_volume::DOUBLE AS total_volume FROM bars WHERE hour(window_start) * 60 + minute(window_start) BETWEEN 570 AND 959 AND day(window_start) % 5 <> 0""",
)
def candle_arrays_to_bars(spark, d):
    b = half_hours(spark, d).withColumn("day", F.to_date("window_start"))
    day = b.groupBy("symbol", "day").agg(F.array_sort(F.collect_list(F.struct(F.unix_timestamp(F.col("window_start").cast("timestamp")).alias("t"), "open", "high", "low", "close", F.col("total_volume").cast("double").alias("v")))).alias("x"))
    # every fifth day's answer is damaged
    v = F.when(F.dayofmonth("day") % 5 == 0, F.slice("x.v", 2, 10_000)).otherwise(F.col("x.v"))
    at = F.col("day").cast("timestamp")
    p = day.select("symbol", (at + F.expr("interval 570 minutes")).alias("market_open"), (at + F.expr("interval 960 minutes")).alias("market_close"), F.struct(F.col("x.t").alias("t"), F.col("x.open").alias("o"), F.col("x.high").alias("h"), F.col("x.low").alias("l"), F.col("x.close").alias("c"), v.alias("v")).alias("candles"))
    return T.candles(p).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
