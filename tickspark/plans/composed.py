"""Composed jobs: loads that evolve their table, the training frame, batch forecasts, releases of a history, old versions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import coverage as V
from tickspark.operators import evaluation as E
from tickspark.operators import monitoring as M
from tickspark.operators import universe as U
from tickspark.operators.bars import ohlcv
from tickspark.plans.common import BARS, GAPPY, SYMBOLS, TRADES, register, trades
from tickspark.plans.features import labelled
from tickspark.plans.market import gappy, half_hours, rounded
from tickspark.plans.models import OFFSETS, forecasts
from tickspark.plans.operations import BRANDS, PUBLISHED, book, brands, ntz
from tickspark.plans.sessions import GRID, sess
from tickspark.sources import releases, tables
from tickspark.sources.tables import workspace

# Loads: bars with gaps in two parts, the second of which has a column more


def loaded(spark, d):
    b = gappy(spark, d).withColumn("total_volume", F.lit(1).cast("long"))
    table = jobs.LoadedTable(spark, workspace(spark, "loaded"))
    table.load(b.drop("open").where(F.col("window_start") < ntz("2024-01-20")), "first")
    table.load(b, "second")
    return table, b


@register(
    "load_evolved",
    f"""WITH {GAPPY} SELECT symbol, window_start, window_start AS event_timestamp, coalesce(last_value(close IGNORE NULLS) OVER p, first_value(close IGNORE NULLS) OVER a) AS close,
CASE WHEN window_start >= TIMESTAMP '2024-01-20 00:00:00' THEN coalesce(last_value(open IGNORE NULLS) OVER p, first_value(open IGNORE NULLS) OVER a) END AS open
FROM gappy WINDOW p AS (PARTITION BY symbol ORDER BY window_start), a AS (ORDER BY symbol, window_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def load_evolved(spark, d):
    """Filled and loaded in parts, with a column that the first part lacks."""
    return loaded(spark, d)[0].rows().read().select("symbol", "window_start", "event_timestamp", "close", "open")


@register(
    "load_runs",
    f"""WITH {BARS}, n AS (SELECT count(*) FILTER (window_start < TIMESTAMP '2024-01-20 00:00:00') AS a, count(*) FILTER (window_start >= TIMESTAMP '2024-01-20 00:00:00') AS b, max(window_start) FILTER (window_start < TIMESTAMP '2024-01-20 00:00:00') AS first_end, max(window_start) AS last_end FROM bars)
SELECT 'first' AS run_id, 1::BIGINT AS version, 1 AS schema_version, a AS inserted, first_end AS newest FROM n UNION ALL SELECT 'second', 2, 2, b, last_end FROM n UNION ALL SELECT 'again', 3, 2, 0, NULL FROM n""",
)
def load_runs(spark, d):
    table, b = loaded(spark, d)
    table.load(b, "again")
    return table.runs.latest("run_id").drop("recorded_ns")


# Training


@register(
    "training_frame",
    f"""WITH {PUBLISHED}, f AS (SELECT fit.*, b.window_end, b.total_volume FROM fit JOIN bars b USING (symbol, window_start)), l AS (SELECT * FROM f WHERE hour(window_start) < 16), h AS (SELECT * REPLACE (close + 1 AS close) FROM f WHERE hour(window_start) >= 12),
u AS (SELECT symbol, window_start, window_end, close, total_volume FROM l UNION ALL SELECT symbol, window_start, window_end, close, total_volume FROM h ANTI JOIN l USING (symbol, window_start)),
k AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY window_end) AS p FROM u WHERE symbol <> 'error' AND window_end >= TIMESTAMP '2024-01-08 00:00:00' AND window_end <= TIMESTAMP '2024-01-28 00:00:00')
SELECT symbol, window_end AS event_timestamp, row_number() OVER (PARTITION BY symbol ORDER BY window_end)::INTEGER AS time_idx, hour(window_end)::INTEGER AS hour, round(ln(1 + total_volume), 8) AS log_volume, round(ln(close), 8) AS log_close, round(ln(close) - ln(p), 8) AS target FROM k WHERE p IS NOT NULL""",
)
def training_frame(spark, d):
    rows = labelled(spark, d).withColumn("dataset_version", F.concat(F.lit("r"), F.date_format("window_start", "yyyyMMdd")))
    late = rows.where(F.hour("window_start") >= 12).withColumn("close", F.col("close") + 1)
    m = jobs.training_frame(rows.where(F.hour("window_start") < 16), late, book(spark, d), [s for s in SYMBOLS if s != "error"], ntz("2024-01-28"), days=20, least=3)
    return rounded(m.select("symbol", "event_timestamp", "time_idx", "hour", "log_volume", "log_close", "target"), "log_volume", "log_close", "target")


# Forecasts: the newest returns of each symbol, in reverse, stand for a model's medians

NOW = "2024-01-12 18:00:00"
FORECAST = f"""{OFFSETS}, {GRID}, {BARS}, hb AS (SELECT * FROM bars WHERE window_end <= TIMESTAMP '{NOW}'), rt AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) AS horizon, ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY window_end)) AS m FROM hb),
  lt AS (SELECT symbol, max(window_end) AS last, arg_max(close, window_end) AS base FROM hb GROUP BY symbol), rn AS (SELECT symbol, horizon, sum(m) OVER (PARTITION BY symbol ORDER BY horizon) AS m FROM rt WHERE horizon <= 13),
  en AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS step, window_start + INTERVAL 30 MINUTE AS event_timestamp FROM lt JOIN starts ON window_start + INTERVAL 30 MINUTE > last),
  fp AS (SELECT symbol, horizon AS step, event_timestamp, base, quantile, base * exp(rn.m + "offset") AS price FROM rn JOIN off USING (horizon) JOIN lt USING (symbol) JOIN en USING (symbol) WHERE en.step = horizon)"""


def batch_forecast(spark, d):
    b = half_hours(spark, d).where(F.col("window_end") <= ntz(NOW)).withColumn("event_timestamp", F.col("window_end"))
    w = W.partitionBy("symbol").orderBy("window_end")
    r = b.select("symbol", F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("window_end"))).alias("horizon"), (F.log("close") - F.log(F.lag("close").over(w))).alias("_m")).where("horizon <= 13")
    p = r.select("symbol", "horizon", F.explode(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("quantile"), "_m").withColumn("y_pred", F.col("_m") + (F.col("quantile") - 0.5) * 0.01).drop("_m")
    return jobs.batch_forecast(p, E.residual_offsets(forecasts(spark, d)), b, sess(spark, d), 5, decoder=13)


@register("forecast_steps", f"WITH {FORECAST} SELECT symbol, step::INTEGER AS step, event_timestamp, round(max(price) FILTER (quantile = 0.1), 4) AS p10, round(max(price) FILTER (quantile = 0.5), 4) AS p50, round(max(price) FILTER (quantile = 0.9), 4) AS p90 FROM fp WHERE step <= 5 GROUP BY symbol, step, event_timestamp")
def forecast_steps(spark, d):
    """Five steps of a decoder of thirteen, with the first five of its times."""
    return batch_forecast(spark, d).steps


@register("forecast_summary", f"WITH {FORECAST} SELECT symbol, 5 AS horizon, round(base, 4) AS base_price, round(price - base, 4) + 0.0 AS absolute_change, round((price - base) / base, 4) + 0.0 AS percent_change FROM fp WHERE step = 5 AND quantile = 0.5")
def forecast_summary(spark, d):
    return batch_forecast(spark, d).summary


# Tables and releases


@register(
    "pinned_version",
    f"""WITH {BARS} SELECT 'pinned' AS version, symbol, count(*) AS n, round(sum(close), 6) AS closes FROM bars WHERE window_start < TIMESTAMP '2024-01-15 00:00:00' GROUP BY symbol
UNION ALL SELECT 'newest', symbol, count(*), round(sum(close + CASE WHEN symbol = 'view' THEN 1 ELSE 0 END), 6) FROM bars GROUP BY symbol""",
)
def pinned_version(spark, d):
    """The first version of a table that was updated, compacted and expired since, beside the newest."""
    b = half_hours(spark, d)
    table = tables.VersionedTable(spark, workspace(spark, "pinned"), b.schema).create_if_missing()
    first = table.append(b.where(F.col("window_start") < ntz("2024-01-15")))
    table.upsert(b.withColumn("close", F.when(F.col("symbol") == "view", F.col("close") + 1).otherwise(F.col("close"))))
    table.compact(above=0)
    table.expire(keep=1, hours=1)
    both = table.read(first).withColumn("version", F.lit("pinned")).unionByName(table.read().withColumn("version", F.lit("newest")))
    return rounded(both.groupBy("version", "symbol").agg(F.count("*").alias("n"), F.sum("close").alias("closes")), "closes", digits=6)


@register(
    "history_backfill",
    f"""WITH {GRID}, {TRADES}, bars AS (SELECT time_bucket(INTERVAL 30 MINUTE, event_time) AS window_start, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS symbol, arg_min(price, event_time) AS open, min(price) AS low, arg_max(price, event_time) AS close, sum(volume)::BIGINT AS total_volume FROM trades GROUP BY ALL),
x AS (SELECT session_date, b.* FROM bars b JOIN sess s ON window_start >= market_open AND window_start < market_close), n AS (SELECT session_date, count(*) AS expected FROM starts GROUP BY session_date),
good AS (SELECT session_date FROM x GROUP BY session_date HAVING count(*) = 2 * (SELECT expected FROM n WHERE n.session_date = x.session_date) AND min(low) > 0 AND min(total_volume) > 0),
f AS (SELECT symbol, window_start + INTERVAL 30 MINUTE AS event_timestamp, round(avg(close) OVER w, 8) AS rolling_avg_close, round(stddev_samp(close) OVER w, 8) AS rolling_volatility_close FROM x WHERE session_date IN (FROM good) WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)), g AS (FROM f WHERE rolling_volatility_close IS NOT NULL)
SELECT g.*, (SELECT count(*) FROM g) AS row_count, 1::BIGINT AS releases FROM g""",
)
def history_backfill(spark, d):
    """The release of all sessions that the bars fill, made twice: the second run finds the first one's. Two symbols, by even and
    odd ids, so that sessions are full."""
    t = trades(spark, d).withColumn("symbol", F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd"))
    b, s, path = ohlcv(t), sess(spark, d), workspace(spark, "backfill")
    good = V.qualify_sessions(b, s, ["even", "odd"]).groupBy("session_date").agg(F.min("passed").alias("_p")).where("_p").select("session_date")
    s = s.join(good, "session_date", "left_semi")
    kept = V.in_session(b, s, "window_start").select(b.columns)
    folder = releases.backfill(kept, s, ["even", "odd"], path)
    if releases.backfill(kept, s, ["even", "odd"], path) != folder:
        raise releases.Refused("a second run made another release")
    m = releases.manifests(spark, path).agg(F.max("row_count").alias("row_count"), F.count("*").alias("releases"))
    f = spark.read.parquet(f"{folder}/features").select("symbol", "event_timestamp", "rolling_avg_close", "rolling_volatility_close")
    return rounded(f, "rolling_avg_close", "rolling_volatility_close").crossJoin(F.broadcast(m))  # one row


@register("universe_published", f"WITH {BRANDS} SELECT symbol FROM br")
def universe_published(spark, d):
    """A refresh whose churn is within its limit, read again as the governed universe."""
    b, folder = brands(spark, d), workspace(spark, "published")
    done = jobs.universe_refresh(b.where(F.right("symbol", F.lit(1)) != "1"), b, folder, "run", ntz("2024-01-20"), least=1, limit=0.5)
    if not done.first().published:
        raise releases.Refused("the refresh was not published")
    return U.governed(spark, folder, ntz("2024-01-20 12:00:00"))


@register(
    "interior_gap_alerts",
    f"""WITH {GRID}, {BARS}, k AS (SELECT g.session_date, g.symbol, g.window_start, b.symbol IS NOT NULL AS held FROM grid g LEFT JOIN bars b USING (symbol, window_start)), e AS (SELECT session_date, symbol, min(window_start) AS a, max(window_start) AS z FROM k WHERE held GROUP BY ALL)
SELECT 'interior_gaps' AS metric, symbol AS key, session_date::TIMESTAMP AS window_start, count(*)::DOUBLE AS value, 0.0::DOUBLE AS "limit" FROM k JOIN e USING (session_date, symbol) WHERE NOT held AND window_start > a AND window_start < z GROUP BY symbol, session_date""",
)
def interior_gap_alerts(spark, d):
    """A row a symbol and session that lacks bars between its first and last."""
    gaps = V.interior_gaps(half_hours(spark, d), sess(spark, d)).groupBy("symbol", "session_date").agg(F.count("*").cast("double").alias("value"))
    return M.firing_alerts(gaps.select(F.lit("interior_gaps").alias("metric"), F.col("symbol").alias("key"), F.col("session_date").cast("timestamp_ntz").alias("window_start"), "value"))
