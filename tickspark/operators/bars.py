"""Bars, rolling features and per-symbol series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BAR_WIDTH = "30 minutes"
LOOKBACK = 60


def ohlcv(trades: DataFrame, width: str = BAR_WIDTH, sequence: str | None = None) -> DataFrame:
    """Tumbling bars of each symbol, on a batch or a stream. ``sequence`` orders trades of one instant."""
    order = F.col("event_time") if sequence is None else F.struct("event_time", sequence)
    bars = trades.groupBy(F.window("event_time", width).alias("_w"), "symbol").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("volume").alias("total_volume")
    )
    return bars.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "symbol", "open", "high", "low", "close", "total_volume")


def resample(bars: DataFrame, width: str) -> DataFrame:
    """Coarser bars; bucketed by window_start, since a bar's label is its end."""
    out = bars.groupBy(F.window("window_start", width).alias("_w"), "symbol").agg(
        F.min_by("open", "window_start").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "window_start").alias("close"), F.sum("total_volume").alias("total_volume")
    )
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "symbol", "open", "high", "low", "close", "total_volume")


#: The names of the features.
FEATURES = ("avg_close", "volatility_close", "returns", "log_returns")


def rolling(bars: DataFrame, features: Sequence[str] = FEATURES, lookback: int = LOOKBACK) -> DataFrame:
    """Features over the current bar and ``lookback`` before it, in one shuffle and sort by symbol."""
    unknown = sorted(set(features) - set(FEATURES))
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    missing = sorted({"symbol", "window_start", "close"} - set(bars.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    series = W.partitionBy("symbol").orderBy("window_start")
    frame, before = series.rowsBetween(-lookback, 0), F.lag("close").over(series)
    made: dict[str, tuple[str, Column]] = {
        "avg_close": ("rolling_avg_close", F.avg("close").over(frame)),
        "volatility_close": ("rolling_volatility_close", F.stddev_samp("close").over(frame)),
        "returns": ("returns", F.try_divide(F.col("close") - before, before)),
        "log_returns": ("log_returns", F.when((F.col("close") > 0) & (before > 0), F.log(F.col("close")) - F.log(before))),
    }
    return bars.select("*", *[made[f][1].alias(made[f][0]) for f in FEATURES if f in features])


def bounded_history(bars: DataFrame, opening: Column, closing: Column, lookback: int = LOOKBACK) -> DataFrame:
    """The last ``lookback`` bars of each symbol before the opening, with the bars of the session."""
    recent = W.partitionBy("symbol").orderBy(F.desc("window_start"))
    past = bars.where(F.col("window_start") < opening).withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= lookback).drop("_r")
    return past.unionByName(bars.where((F.col("window_start") >= opening) & (F.col("window_start") < closing)))


def last_rows(df: DataFrame, k: int, key: str = "symbol", order: str = "window_start") -> DataFrame:
    latest = W.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= k).drop("_r")


def time_index(df: DataFrame, order: str = "window_start", key: str = "symbol") -> DataFrame:
    return df.withColumn("time_idx", F.row_number().over(W.partitionBy(key).orderBy(order)) - 1)


def dedupe_latest(df: DataFrame, keys: Sequence[str], *ties: Column) -> DataFrame:
    """One row a key, the one that sorts first by ``ties``."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*ties))).where("_r = 1").drop("_r")


def log_return_target(df: DataFrame, order: str = "window_start", training: bool = True) -> DataFrame:
    """target: one-step log return. Training drops each symbol's first row, and fails on a close that isn't positive; serving
    puts 0."""
    close = F.col("close")
    if training:
        close = F.when(close <= 0, F.raise_error(F.lit("closes must be positive"))).otherwise(close)
    step = F.log(close) - F.lag(F.log(close)).over(W.partitionBy("symbol").orderBy(order))
    out = df.withColumn("target", step)
    return out.where("target is not null") if training else out.fillna(0.0, ["target"])
