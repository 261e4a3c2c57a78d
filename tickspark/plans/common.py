"""The inputs that the registered queries share, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.sources.trades import event_trades

QUERIES: dict = {}
ORACLES: dict = {}

AS_OF = "2024-01-20 00:00:00"
SYMBOLS = ["click", "purchase", "signup", "view", "error"]


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def trades(spark: SparkSession, d: str) -> DataFrame:
    return event_trades(read(spark, d, "events"))


def faulty(spark: SparkSession, d: str) -> DataFrame:
    """Trades with faults at fixed places, for the quality operators to find."""
    k = F.col("event_id")
    return trades(spark, d).withColumns(
        {
            "symbol": F.when(k % 83 == 0, " ").otherwise(F.col("symbol")),
            "price": F.when(k % 97 == 0, F.lit(-1.0)).when(k % 101 != 0, F.col("price")),
            "volume": F.when(k % 89 == 0, F.lit(-5).cast("long")).otherwise(F.col("volume")),
            "timestamp": F.when(k % 79 != 0, F.col("timestamp")),
            "event_time": F.when(k % 79 != 0, F.col("event_time")),
        }
    )


TRADES = """trades AS (SELECT event_id, event_type AS symbol, value AS price, CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS BIGINT) AS volume,
  epoch_us(ts) // 1000 AS timestamp, ts AS event_time FROM events)"""

FAULTY = f"""{TRADES}, faulty AS (SELECT event_id, CASE WHEN event_id % 83 = 0 THEN ' ' ELSE symbol END AS symbol,
  CASE WHEN event_id % 97 = 0 THEN -1.0 WHEN event_id % 101 <> 0 THEN price END AS price, CASE WHEN event_id % 89 = 0 THEN -5 ELSE volume END AS volume,
  CASE WHEN event_id % 79 <> 0 THEN timestamp END AS timestamp, CASE WHEN event_id % 79 <> 0 THEN event_time END AS event_time FROM trades)"""

BARS = f"""{TRADES}, bars AS (SELECT time_bucket(INTERVAL 30 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 30 MINUTE, event_time) + INTERVAL 30 MINUTE AS window_end, symbol,
  arg_min(price, event_time) AS open, max(price) AS high, min(price) AS low, arg_max(price, event_time) AS close, sum(volume)::BIGINT AS total_volume
  FROM trades GROUP BY ALL)"""

#: Bars with gaps at fixed places.
GAPPY = f"""{BARS}, gappy AS (SELECT symbol, window_start, window_end, high, low, CASE WHEN (minute(window_start) + hour(window_start) * 60) // 30 % 7 = 3 THEN NULL ELSE close END AS close,
  CASE WHEN symbol = 'error' THEN NULL WHEN hour(window_start) = 0 THEN NULL ELSE open END AS open FROM bars)"""
