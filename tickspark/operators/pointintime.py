"""Point-in-time features: spines, as-of joins, the online view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def entity_spine(span: DataFrame, symbols: Sequence[str], step: str = "24 hours") -> DataFrame:
    """(start, end) to every symbol at every step, both ends in."""
    at = span.select(F.explode(F.sequence("start", "end", F.expr(f"interval {step}"))).alias("event_timestamp"))
    return at.select(F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"), "event_timestamp")


def asof(spine: DataFrame, features: DataFrame, columns: Sequence[str], ttl: str, key: str = "symbol", time: str = "event_timestamp", created: str | None = None, slice_by: str = "month") -> DataFrame:
    """Each spine row with the latest feature row of its key at or before its time, if it is not older than ``ttl``.

    Both sides go through one sort a key and time slice: of equal times the features come first, later ones by ``created``.
    Slices are as long as a month, so a key with a long history is spread; a feature row is also sent to the slices that its
    ``ttl`` reaches into."""
    ttl_ = F.expr(f"interval {ttl}")
    stamp = F.col(created) if created else F.lit(0)
    start = F.date_trunc(slice_by, F.col(time).cast("timestamp"))
    reach = F.date_trunc(slice_by, (F.col(time) + ttl_).cast("timestamp"))
    f = features.select(key, time, F.struct(*columns, F.col(time).alias("feature_timestamp")).alias("_f"), F.lit(0).alias("_side"), stamp.alias("_created"), F.explode(F.sequence(start, reach, F.expr(f"interval 1 {slice_by}"))).alias("_slice"))
    s = spine.withColumns({"_f": F.lit(None).cast(f.schema["_f"].dataType), "_side": F.lit(1), "_created": F.lit(None).cast(f.schema["_created"].dataType), "_slice": start})
    both = s.unionByName(f, allowMissingColumns=True)
    w = W.partitionBy(key, "_slice").orderBy(time, "_side", "_created").rowsBetween(W.unboundedPreceding, 0)
    last = both.withColumn("_f", F.last("_f", ignorenulls=True).over(w)).where("_side = 1")
    valid = F.col("_f.feature_timestamp") >= F.col(time) - ttl_
    return last.select(*spine.columns, *[F.when(valid, F.col("_f")[c]).alias(c) for c in [*columns, "feature_timestamp"]])


def latest_per_key(rows: DataFrame, columns: Sequence[str], key: str = "symbol", time: str = "event_timestamp") -> DataFrame:
    """The newest row of each key, by partial aggregation rather than a sort."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), time).alias("_v"), F.max(time).alias(time)).select(key, time, "_v.*")


def materialise(online: DataFrame, rows: DataFrame, start: Column, end: Column, columns: Sequence[str], key: str = "symbol", time: str = "event_timestamp") -> DataFrame:
    """The online table after the rows of [start, end], which replace older ones only."""
    new = rows.where((F.col(time) >= start) & (F.col(time) <= end)).select(key, time, *columns)
    return latest_per_key(online.select(key, time, *columns).unionByName(new), columns, key, time)


def look_up(request: DataFrame, online: DataFrame, key: str = "symbol") -> DataFrame:
    """The requested keys with their online rows; missing tells which have none."""
    return request.join(online.withColumn("_hit", F.lit(True)), key, "left").withColumn("missing", F.col("_hit").isNull()).drop("_hit")


def parity(offline: DataFrame, online: DataFrame, key: str = "symbol", value: str = "close") -> DataFrame:
    """Whether both sides' values agree within max(1e-4, 1e-5 |offline|)."""
    both = offline.select(key, F.col(value).alias("offline")).join(online.select(key, F.col(value).cast("double").alias("online")), key, "left")
    near = F.abs(F.col("offline") - F.col("online")) <= F.greatest(F.lit(1e-4), F.abs("offline") * 1e-5)
    return both.withColumn("agrees", F.coalesce(near, F.lit(False)))


def with_online(history: DataFrame, online: DataFrame, keys: Sequence[str] = ("symbol", "event_timestamp")) -> DataFrame:
    """The history with the online rows, which win where both have a key."""
    union = online.withColumn("_p", F.lit(0)).unionByName(history.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return union.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("_p"))).where("_r = 1").drop("_r", "_p")


def page(rows: DataFrame, limit: int, key: str = "symbol", time: str = "event_timestamp") -> DataFrame:
    """The last ``limit`` rows of each key, and whether there were more."""
    w = W.partitionBy(key)
    ranked = rows.withColumns({"_r": F.row_number().over(w.orderBy(F.desc(time))), "_n": F.count("*").over(w)})
    return ranked.where(F.col("_r") <= limit).withColumn("truncated", F.col("_n") > limit).drop("_r", "_n")


def paired_spine(spark, symbols: Sequence[str], times: Sequence[str]) -> DataFrame:
    """One row a pair of two lists of equal length."""
    if len(symbols) != len(times):
        raise ValueError("symbols and times differ in number")
    return spark.createDataFrame(list(zip(symbols, times, strict=True)), "symbol string, event_timestamp string").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def materialise_since(online: DataFrame, rows: DataFrame, now: Column, columns: Sequence[str], max_backfill_days: int = 30, key: str = "symbol", time: str = "event_timestamp") -> DataFrame:
    """Incremental: the rows after the newest time that is online, up to ``now``; with nothing online the last
    ``max_backfill_days``, which also bound how far an old online table reaches back."""
    oldest = now - F.expr(f"interval {max_backfill_days} days")
    marks = online.agg(F.greatest(F.coalesce(F.max(time), oldest), oldest).alias("_since"))  # one row
    new = rows.crossJoin(F.broadcast(marks)).where((F.col(time) > F.col("_since")) & (F.col(time) <= now)).select(key, time, *columns)
    return latest_per_key(online.select(key, time, *columns).unionByName(new), columns, key, time)
