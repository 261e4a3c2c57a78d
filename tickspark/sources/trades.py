"""Trade sources: wire decoding, provider normalisation, candle payloads and CSV bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.schemas import BAR, CANDLES, RAW_TRADE


def kafka_options(servers: str, topic: str, starting: str = "latest", per_trigger: int = 50_000, fail_on_loss: bool = True) -> dict[str, str]:
    """Options of the stream source; the connector itself is a deployment's matter."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": str(fail_on_loss).lower()}


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**options).load())


def replay_range(spark: SparkSession, servers: str, topic: str, starting: str, ending: str) -> DataFrame:
    """A bounded range of offsets with its provenance columns."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "endingOffsets": ending}
    return spark.read.format("kafka").options(**options).load().select("topic", "partition", "offset", "key", "value")


def millis(col: Column) -> Column:
    """Epoch milliseconds to an instant without losing the milliseconds."""
    return F.timestamp_millis(col)


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON in ``value`` to trade columns and event_time; what can't be read becomes nulls, for the quality split to reject."""
    parsed = F.from_json(F.col(value).cast("string"), RAW_TRADE)
    return df.select(parsed.alias("_t")).select("_t.*").withColumn("event_time", millis(F.col("timestamp")))


def event_trades(events: DataFrame) -> DataFrame:
    """An event table (event_type, value, props, ts) as trades."""
    return events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("ts").alias("event_time"),
    )


def normalise(messages: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Provider messages with short or long field names to trades; unlisted symbols and values that aren't positive go.

    A short name that is missing, empty or 0 falls through to the long one."""

    def either(short: str, long: str, kind: str) -> Column:
        a = F.col(f"_d.{short}")
        empty = (a == "") if kind == "string" else (a == 0)
        return F.when(a.isNull() | empty, F.col(f"_d.{long}")).otherwise(a).cast(kind)

    each = messages.select("message_id", F.posexplode("data").alias("position", "_d"))
    out = each.select(
        "message_id",
        "position",
        F.upper(F.trim(either("s", "symbol", "string"))).alias("symbol"),
        either("p", "price", "double").alias("price"),
        either("v", "size", "double").alias("volume"),
        either("t", "timestamp", "long").alias("timestamp"),
    )
    finite = (F.abs("price") < float("inf")) & (F.abs("volume") < float("inf"))
    return out.where(F.col("symbol").isin(list(symbols)) & finite & (F.col("price") > 0) & (F.col("volume") > 0) & F.col("timestamp").isNotNull())


def consumed(records: DataFrame) -> DataFrame:
    """Records (key, value JSON, consumed_at ms, produced_at ms) as rows with latencies; fields that can't be cast are null."""
    t = F.from_json("value", "symbol string, price string, volume string, timestamp string")
    r = records.withColumn("_t", t)
    r = r.select(
        "record_id",
        F.coalesce(F.nullif(F.trim("_t.symbol"), F.lit("")), "key").alias("symbol"),
        F.expr("try_cast(_t.price as double)").alias("price"),
        F.expr("try_cast(_t.volume as double)").alias("volume"),
        F.expr("try_cast(_t.timestamp as bigint)").alias("timestamp"),
        "consumed_at",
        "produced_at",
    )
    return r.withColumns({"end_to_end_latency_ms": F.col("consumed_at") - F.col("produced_at"), "market_latency_ms": F.col("consumed_at") - F.col("timestamp")})


def candles(payloads: DataFrame, minutes: int = 30) -> DataFrame:
    """Payloads (symbol, market_open, market_close, candles) to bars inside the session; uneven arrays give no bars."""
    c = payloads.withColumn("_c", F.col("candles").cast(CANDLES))
    even = " and ".join(f"size(_c.t) = size(_c.{x})" for x in "ohlcv")
    rows = c.where(even).select("symbol", "market_open", "market_close", F.inline(F.arrays_zip("_c.t", "_c.o", "_c.h", "_c.l", "_c.c", "_c.v")))
    start = F.timestamp_seconds("t")
    rows = rows.withColumn("window_start", start).where((F.col("window_start") >= F.col("market_open")) & (F.col("window_start") < F.col("market_close")))
    return rows.select(
        "symbol", "window_start", (F.col("window_start") + F.expr(f"interval {minutes} minutes")).alias("window_end"),
        F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"), F.col("c").alias("close"), F.col("v").alias("total_volume"),
    )


def csv_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BAR).option("header", True).csv(path)


def reconcile(records: DataFrame, bounds: DataFrame) -> DataFrame:
    """Per partition of a replay: what its bounds (partition, start, end_exclusive) promise and what was read: expected, rows,
    first, last, repeated offsets, and whether the range is complete."""
    inside = records.join(F.broadcast(bounds), "partition").where((F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("end_exclusive")))
    # one row an offset first, so that a partition with most records is spread
    each = inside.groupBy("partition", "offset").agg(F.count("*").alias("_n"))
    read = each.groupBy("partition").agg(F.count("*").alias("offsets"), F.sum(F.col("_n") - 1).alias("repeated"), F.min("offset").alias("first"), F.max("offset").alias("last"))
    out = bounds.join(read, "partition", "left").fillna(0, ["offsets", "repeated"]).withColumn("expected", F.col("end_exclusive") - F.col("start"))
    return out.select("partition", "start", "end_exclusive", "expected", "offsets", "repeated", "first", "last", (F.col("offsets") == F.col("expected")).alias("complete"))


def replay(records: DataFrame, symbols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Valid trades with their topic, partition and offset, and the quarantine: where a rejected record was, why, and its bytes."""
    t = F.from_json(F.col("value").cast("string"), RAW_TRADE)
    price, volume, stamp = F.col("_t.price"), F.col("_t.volume"), F.col("_t.timestamp")
    reason = (
        F.when(F.col("_t").isNull() | F.col("_t.symbol").isNull() & price.isNull() & stamp.isNull(), "unreadable")
        .when(~F.coalesce(F.col("_t.symbol").isin(list(symbols)), F.lit(False)), "symbol")
        .when(~F.coalesce((price > 0) & (price < float("inf")), F.lit(False)), "price")
        .when(~F.coalesce((volume > 0) & (volume < float("inf")), F.lit(False)), "volume")
        .when(~F.coalesce((stamp >= 10**12) & (stamp < 10**14), F.lit(False)), "timestamp")
    )
    r = records.withColumn("_t", t).withColumn("reason", reason)
    place = ["topic", "partition", "offset"]
    good = r.where("reason is null").select("_t.*", *place).withColumn("event_time", millis(F.col("timestamp")))
    return good, r.where("reason is not null").select(*place, "reason", F.base64(F.col("value").cast("binary")).alias("payload_base64"))


def bounded_replay(bounds: DataFrame, most: int = 1_000_000) -> int:
    """How many records the bounds hold; an error beyond ``most``, for a recovery is then to be cut by partition."""
    n = bounds.agg(F.coalesce(F.sum(F.col("end_exclusive") - F.col("start")), F.lit(0))).first()[0]
    if n > most:
        raise ValueError(f"{n} records are more than the {most} of one recovery")
    return n
