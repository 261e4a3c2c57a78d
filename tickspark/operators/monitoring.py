"""Health of ingestion and serving, and alert conditions over metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ingestion_health(records: DataFrame, now: Column) -> DataFrame:
    """One row: how many records, errors, symbols, the last offset and the age of the last trade."""
    bad = F.col("price").isNull() | (F.col("price") <= 0)
    age = (F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.max("event_time").cast("timestamp"))) / 1000
    return records.agg(
        F.count("*").alias("messages"), F.count_if(bad).alias("errors"), F.round(F.try_divide(F.count_if(bad) * 100.0, F.count("*")), 6).alias("error_pct"),
        F.count_distinct(F.nullif(F.trim("symbol"), F.lit(""))).alias("symbols"), F.max("offset").alias("last_offset"), F.round(age).alias("age_seconds"),
    )


def slo_rollup(requests: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Requests (ts, status, latency, cached) by window: rate, share of 5xx, p95 of the latency, cache hits."""
    w = requests.groupBy(F.window("ts", width).alias("_w")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("failed"), F.percentile("latency", 0.95).alias("p95_latency"), F.count_if("cached").alias("hits")
    )
    return w.select(F.col("_w.start").alias("window_start"), "requests", (F.col("failed") / F.col("requests")).alias("error_ratio"), "p95_latency", (F.col("hits") / F.col("requests")).alias("hit_ratio"))


def with_halo(rows: DataFrame, seconds: int, time: str = "window_start") -> DataFrame:
    """``rows`` dealt to slices of a day (``_day``), each with the rows of the ``seconds`` before it; ``own`` rows are the slice's."""
    if not 0 < seconds < 86_400:
        raise ValueError("a halo is shorter than a slice")
    days = F.array_distinct(F.array(F.to_date(time), F.to_date(F.col(time) + F.expr(f"interval {seconds} seconds"))))
    return rows.withColumn("_day", F.explode(days))


def own(rows: DataFrame, time: str = "window_start") -> DataFrame:
    """Each row once, from its own slice."""
    return rows.where(F.col("_day") == F.to_date(time)).drop("_day")


#: Fixed values, as the alerts are defined: minutes for which error burn and slow answers hold before they fire.
BURN_FOR, SLOW_FOR = 5, 10


def burn(rollup: DataFrame, fast: float = 0.05, slow: float = 0.01, latency: float = 1.0, slow_windows: int = 12, step: int = 5) -> DataFrame:
    """Conditions of each window: errors over the fast limit now and over the slow one in the last hour, and slow answers;
    whether each has held long enough to fire: in this window and in all that start up to that many minutes before.

    Slices of a day carry what their first windows look back to, so the hour knows no midnight and no task holds the whole
    history. Windows without requests hold nothing."""
    second = F.unix_timestamp(F.col("window_start").cast("timestamp"))

    def back(seconds: int):
        return W.partitionBy("_day").orderBy(second).rangeBetween(-seconds, 0)

    hour = back(60 * step * (slow_windows - 1))
    failed = F.sum(F.col("error_ratio") * F.col("requests")).over(hour) / F.sum("requests").over(hour)
    out = with_halo(rollup, 60 * (step * (slow_windows - 1) + max(BURN_FOR, SLOW_FOR))).withColumn("hour_error_ratio", failed)
    out = out.withColumns({"availability_burn": (F.col("error_ratio") > fast) & (F.col("hour_error_ratio") > slow), "slow": F.col("p95_latency") > latency})

    def firing(condition: str, minutes: int) -> Column:
        return F.count_if(condition).over(back(60 * minutes)) == minutes // step + 1

    return own(out.withColumns({"burn_firing": firing("availability_burn", BURN_FOR), "slow_firing": firing("slow", SLOW_FOR)}))


#: Values that a latency sketch keeps at a level: up to so many it is exact, beyond them its rank error is below 0.1 %.
SKETCH = 4096


def slo_slices(requests: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Mergeable rows of a window: counts, and a KLL sketch of the latency. A slice has the same size however many requests it saw."""
    w = requests.groupBy(F.window("ts", width).alias("_w")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("failed"), F.count_if("cached").alias("hits"), F.kll_sketch_agg_double(F.col("latency").cast("double"), F.lit(SKETCH)).alias("latency")
    )
    return w.select(F.col("_w.start").alias("window_start"), "requests", "failed", "hits", "latency")


def sliding_slo(slices: DataFrame, windows: int = 12, step: int = 5) -> DataFrame:
    """Per window the roll-up of it and of those before it, ``windows`` in all, from slices alone: a slice goes to the windows
    that it is part of, and counts and sketches are merged there."""
    ends = F.sequence(F.col("window_start"), F.col("window_start") + F.expr(f"interval {step * (windows - 1)} minutes"), F.expr(f"interval {step} minutes"))
    each = slices.select(F.explode(ends).alias("_end"), "*")
    merged = each.groupBy("_end").agg(F.sum("requests").alias("requests"), F.sum("failed").alias("failed"), F.sum("hits").alias("hits"), F.kll_merge_agg_double("latency", F.lit(SKETCH)).alias("_l"), F.max("window_start").alias("_last"))
    merged = merged.where(F.col("_last") == F.col("_end"))  # a window that had no requests has no row
    return merged.select(F.col("_end").alias("window_start"), "requests", (F.col("failed") / F.col("requests")).alias("error_ratio"), F.kll_sketch_get_quantile_double("_l", F.lit(0.95)).alias("p95_latency"), (F.col("hits") / F.col("requests")).alias("hit_ratio"))


def held_for(metrics: DataFrame, condition: Column, windows: int, keys: list[str], order: str) -> DataFrame:
    """firing: the condition holds in this window and in the ``windows`` - 1 before it."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(1 - windows, 0)
    out = metrics.withColumn("_c", F.coalesce(condition, F.lit(False)).cast("int"))
    return out.withColumn("firing", (F.min("_c").over(w) == 1) & (F.count("*").over(w) == windows)).drop("_c")


def readiness(online: DataFrame, offline: DataFrame, required: Column) -> DataFrame:
    """Per symbol: whether the offline data reach the required close, and whether the online close agrees with the offline one."""
    last = offline.groupBy("symbol").agg(F.max("event_timestamp").alias("cutoff"), F.max_by("close", "event_timestamp").alias("offline_close"))
    both = last.join(online.select("symbol", F.col("close").alias("online_close")), "symbol", "left")
    near = F.abs(F.col("offline_close") - F.col("online_close")) <= F.greatest(F.lit(1e-4), 1e-5 * F.abs("offline_close"))
    return both.withColumns({"fresh": F.col("cutoff") >= required, "parity": F.coalesce(near, F.lit(False))}).withColumn("ready", F.col("fresh") & F.col("parity"))


def snapshot_freshness(rows: DataFrame, now: Column, time: str = "event_timestamp") -> DataFrame:
    """One row: the newest time and its age in seconds."""
    age = (F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.max(time).cast("timestamp"))) / 1000
    return rows.agg(F.max(time).alias("newest"), age.alias("staleness_seconds"))


def partition_offsets(records: DataFrame) -> DataFrame:
    """Per partition: messages and the last offset."""
    return records.groupBy("partition").agg(F.count("*").alias("messages"), F.max("offset").alias("last_offset"))


def symbol_age(trades: DataFrame, now: Column, symbols: list[str], started: Column) -> DataFrame:
    """Per listed symbol: seconds since its last trade, or since ``started`` without one."""
    last = trades.groupBy("symbol").agg(F.max("event_time").alias("last_trade"))
    listed = trades.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    since = F.coalesce(F.col("last_trade"), started)
    return listed.join(last, "symbol", "left").withColumn("age_seconds", (F.unix_millis(now.cast("timestamp")) - F.unix_millis(since.cast("timestamp"))) / 1000)


def rates(records: DataFrame, width: str = "5 minutes", time: str = "event_time") -> DataFrame:
    """Per window: messages, messages a second, and the share that has no positive price."""
    bad = F.col("price").isNull() | (F.col("price") <= 0)
    w = records.groupBy(F.window(time, width).alias("_w")).agg(F.count("*").alias("messages"), F.count_if(bad).alias("errors"))
    seconds = F.unix_timestamp(F.col("_w.end").cast("timestamp")) - F.unix_timestamp(F.col("_w.start").cast("timestamp"))
    return w.select(F.col("_w.start").alias("window_start"), "messages", (F.col("messages") / seconds).alias("rate"), (F.col("errors") / F.col("messages")).alias("error_ratio"))


#: Fixed values, as the alerts are defined: metric, limit, and the minutes for which it is over the limit.
ALERTS = [("kafka_lag", 1000.0, 10), ("dead_letters", 0.0, 0), ("symbol_age_seconds", 120.0, 0), ("interior_gaps", 0.0, 0), ("consumer_error_ratio", 0.05, 5)]


def firing_alerts(metrics: DataFrame, step: int = 5) -> DataFrame:
    """``metrics`` (metric, key, window_start, value; a window every ``step`` minutes) that are over their limits, and have been
    for as long as the alert asks."""
    limits = metrics.sparkSession.createDataFrame([(m, x, max(1, -(-n // step))) for m, x, n in ALERTS], "metric string, limit double, windows int")
    over = metrics.join(F.broadcast(limits), "metric").where(F.col("value") > F.col("limit"))
    # windows that follow one another have the same difference of time and number
    w = W.partitionBy("metric", "key").orderBy("window_start")
    number = F.unix_timestamp(F.col("window_start").cast("timestamp")) / (60 * step) - F.row_number().over(w)
    run = over.withColumn("_run", number)
    held = F.row_number().over(W.partitionBy("metric", "key", "_run").orderBy("window_start"))
    return run.withColumn("_held", held).where(F.col("_held") >= F.col("windows")).select("metric", "key", "window_start", "value", "limit")


def operations_readiness(ready: DataFrame, missing: DataFrame, published: DataFrame) -> DataFrame:
    """``readiness`` with missing_bars of each symbol, and the newest complete publication (one row); all must be in order."""
    lacking = missing.groupBy("symbol").agg(F.count("*").alias("missing_bars"))
    out = ready.join(lacking, "symbol", "left").fillna(0, ["missing_bars"]).crossJoin(F.broadcast(published))
    return out.withColumn("operational", F.col("ready") & (F.col("missing_bars") == 0) & F.col("dataset_id").isNotNull())
