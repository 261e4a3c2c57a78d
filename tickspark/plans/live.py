"""Streaming and release queries over the event file, read as a stream until it is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.plans.common import BARS, TRADES, read, register, trades
from tickspark.plans.market import REASONS, half_hours, moment, rounded
from tickspark.schemas import BAR
from tickspark.sources import releases
from tickspark.sources.tables import VersionedTable, workspace
from tickspark.sources.trades import event_trades
from tickspark.streaming import live, liveness

ONCE = {"availableNow": True}


def stream_of(spark, d):
    s = spark.readStream.schema(read(spark, d, "events").schema).parquet(f"{d}/events*.parquet")
    return event_trades(s).withColumn("event_time", F.col("event_time").cast("timestamp"))


def faulty_stream(spark, d):
    k = F.col("event_id")
    return stream_of(spark, d).withColumns({"symbol": F.when(k % 83 == 0, " ").otherwise(F.col("symbol")), "price": F.when(k % 97 == 0, F.lit(-1.0)).otherwise(F.col("price"))})


@register("stream_ohlcv", f"WITH {BARS} SELECT symbol, window_start, open, high, low, close, total_volume FROM bars WHERE window_end <= (SELECT max(ts) - INTERVAL 2 MINUTE FROM events)")
def stream_ohlcv(spark, d):
    w = workspace(spark, "stream-ohlcv")
    live.append(live.bars_of(stream_of(spark, d)), f"{w}/bars", f"{w}/checkpoint", ONCE, "bars").awaitTermination()
    out = spark.read.parquet(f"{w}/bars")
    return out.select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "open", "high", "low", "close", "total_volume")


@register("stream_dead_letter", f"WITH {TRADES}, faulty AS (SELECT * REPLACE (CASE WHEN event_id % 83 = 0 THEN ' ' ELSE symbol END AS symbol, CASE WHEN event_id % 97 = 0 THEN -1.0 ELSE price END AS price) FROM trades), tagged AS (SELECT event_id, {REASONS}) SELECT coalesce(dq_reason, 'valid') AS dq_reason, count(*) AS n FROM tagged GROUP BY 1")
def stream_dead_letter(spark, d):
    w = workspace(spark, "stream-split")
    write = live.split_writer(f"{w}/bronze", f"{w}/dead", moment().cast("timestamp"))
    live.each_batch(faulty_stream(spark, d), write, f"{w}/checkpoint", ONCE, "split").awaitTermination()
    valid, dead = spark.read.parquet(f"{w}/bronze"), spark.read.parquet(f"{w}/dead")
    tags = valid.select(F.lit("valid").alias("dq_reason")).unionByName(dead.select("dq_reason"))
    return tags.groupBy("dq_reason").agg(F.count("*").alias("n"))


@register("stream_upsert", f"WITH {BARS} SELECT symbol, window_start, close, total_volume::DOUBLE AS total_volume FROM bars")
def stream_upsert(spark, d):
    w = workspace(spark, "stream-upsert")
    table = VersionedTable(spark, f"{w}/gold", BAR).create_if_missing()
    live.each_batch(live.bars_of(stream_of(spark, d)), live.upsert_writer(table), f"{w}/checkpoint", ONCE, "gold", "update").awaitTermination()
    return table.read().select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "close", "total_volume")


@register("stream_liveness", f"WITH {TRADES}, l AS (SELECT symbol, max(event_time) AS last_trade, count(*) AS trades FROM trades GROUP BY symbol) SELECT *, last_trade < (SELECT max(last_trade) FROM l) - INTERVAL 120 SECOND AS stale FROM l")
def stream_liveness(spark, d):
    w = workspace(spark, "stream-liveness")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{w}/seen")

    live.each_batch(live.last_seen(stream_of(spark, d)), keep, f"{w}/checkpoint", ONCE, "seen", "complete").awaitTermination()
    seen = spark.read.parquet(f"{w}/seen").withColumn("last_trade", F.col("last_trade").cast("timestamp_ntz"))
    newest = seen.agg(F.max("last_trade").alias("_now"))
    return live.stale(seen.crossJoin(F.broadcast(newest)), F.col("_now")).drop("_now")


@register(
    "stream_liveness_events",
    f"""WITH {TRADES}, t AS (SELECT symbol, epoch_us(event_time) // 1000 AS t, lead(epoch_us(event_time) // 1000) OVER (PARTITION BY symbol ORDER BY event_time) AS n FROM trades), w AS (SELECT max(t) - 10000 AS w FROM t),
e AS (SELECT symbol, 'stale' AS status, t + 120000 AS m FROM t WHERE n IS NULL OR n - t > 120000 UNION ALL SELECT symbol, 'alive', n FROM t WHERE n - t > 120000)
SELECT symbol, status, make_timestamp(m * 1000) AS "at" FROM e, w WHERE m <= w""",
)
def stream_liveness_events(spark, d):
    """From the stream's own state and timers; nothing is computed after it."""
    w = workspace(spark, "stream-liveness-events")
    with liveness.rocksdb(spark):
        live.append(liveness.transitions(stream_of(spark, d)), f"{w}/events", f"{w}/checkpoint", ONCE, "liveness").awaitTermination()
    return spark.read.schema(liveness.EVENTS).parquet(f"{w}/events").select("symbol", "status", F.col("at").cast("timestamp_ntz").alias("at"))


@register("stream_progress_metrics", "SELECT 'seen' AS name, count(*) AS input_rows, 0::BIGINT AS lag FROM events")
def stream_progress_metrics(spark, d):
    w = workspace(spark, "stream-progress")
    q = live.append(stream_of(spark, d), f"{w}/trades", f"{w}/checkpoint", ONCE, "seen")
    q.awaitTermination()
    rows = spark.createDataFrame(live.progress_rows(q), "name string, batch long, input_rows long, batch_ms long, lag long")
    return rows.groupBy("name").agg(F.sum("input_rows").alias("input_rows"), F.max("lag").alias("lag"))


@register("stream_versions", f"WITH {BARS} SELECT symbol, window_start, close, total_volume::DOUBLE AS total_volume FROM bars")
def stream_versions(spark, d):
    """A versioned table is appended to, compacted, updated and appended to again; its stream, started twice, gives each appended row once."""
    w = workspace(spark, "stream-versions")
    kinds = {f.name: f.dataType for f in BAR.fields}
    rows = half_hours(spark, d).select(*[F.col(n).cast(t).alias(n) for n, t in kinds.items()])
    table, middle = VersionedTable(spark, f"{w}/table", BAR).create_if_missing(), F.lit("2024-01-15").cast("timestamp")

    def take():
        live.append(table.stream(), f"{w}/out", f"{w}/checkpoint", ONCE, "versions").awaitTermination()

    table.append(rows.where(F.col("window_start") < middle), "load", 0)
    take()
    table.compact(above=0)
    table.upsert(rows.where(F.col("symbol") == "view").withColumn("close", F.col("close") + 1))
    table.append(rows.where(F.col("window_start") >= middle), "load", 1)
    table.append(rows.where(F.col("window_start") >= middle), "load", 1)  # comes again
    take()
    return spark.read.schema(BAR).parquet(f"{w}/out").select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "close", "total_volume")


OPENING, CLOSING = "2024-01-19 14:30:00", "2024-01-19 21:00:00"


@register(
    "session_release",
    f"""WITH {BARS}, h AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS r FROM bars WHERE window_start < TIMESTAMP '{OPENING}'), u AS (SELECT symbol, window_start, window_end, close, total_volume FROM h WHERE r <= 60 UNION ALL SELECT symbol, window_start, window_end, close, total_volume FROM bars WHERE window_start >= TIMESTAMP '{OPENING}' AND window_start < TIMESTAMP '{CLOSING}'),
f AS (SELECT symbol, window_start, window_end AS event_timestamp, close, total_volume, round(avg(close) OVER w, 8) AS rolling_avg_close, round(stddev_samp(close) OVER w, 8) AS rolling_volatility_close FROM u WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW))
SELECT * FROM f WHERE window_start >= TIMESTAMP '{OPENING}' AND rolling_volatility_close IS NOT NULL""",
)
def session_release(spark, d):
    f = releases.session_features(half_hours(spark, d), F.lit(OPENING).cast("timestamp_ntz"), F.lit(CLOSING).cast("timestamp_ntz"))
    return rounded(f, "rolling_avg_close", "rolling_volatility_close").select("symbol", "window_start", "event_timestamp", "close", "total_volume", "rolling_avg_close", "rolling_volatility_close")


@register("history_release", f"WITH {BARS}, f AS (SELECT symbol, window_end AS event_timestamp, round(avg(close) OVER w, 8) AS rolling_avg_close, round(stddev_samp(close) OVER w, 8) AS rolling_volatility_close, total_volume FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)) SELECT * FROM f WHERE rolling_volatility_close IS NOT NULL")
def history_release(spark, d):
    f = releases.history_features(half_hours(spark, d))
    return rounded(f, "rolling_avg_close", "rolling_volatility_close").select("symbol", "event_timestamp", "rolling_avg_close", "rolling_volatility_close", "total_volume")
