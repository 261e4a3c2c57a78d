"""Features in buckets: a history that as-of joins read without a shuffle, and an online view whose look-ups read few buckets.

The history holds, for each feature row, the span of time in which it is the newest one of its key. It is cut to slices of time,
and a row is also put in the slices that its time-to-live reaches into; buckets are by key and slice, so a key with most of
all rows is spread. A spine is shuffled to the same buckets, and each of its rows meets the one feature row of its key whose
span it lies in. The view is bucketed by key alone, as bucket pruning asks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SINCE, UNTIL, SLICE = "_since", "_until", "_slice"


def slice_of(time: Column, unit: str) -> Column:
    return F.date_trunc(unit, time.cast("timestamp"))


def write_history(features: DataFrame, table: str, columns: Sequence[str], ttl: str, path: str, buckets: int = 16, key: str = "symbol", time: str = "event_timestamp", created: str | None = None, unit: str = "month") -> None:
    """Of rows with equal key and time the one made last (``created``) is kept. ``path``: a folder that all machines share."""
    reach = slice_of(F.col(time) + F.expr(f"interval {ttl}"), unit)
    rows = features.select(key, F.col(time).alias(SINCE), *columns, (F.col(created) if created else F.lit(0)).alias("_created"), F.explode(F.sequence(slice_of(F.col(time), unit), reach, F.expr(f"interval 1 {unit}"))).alias(SLICE))
    w = W.partitionBy(key, SLICE).orderBy(SINCE, "_created")
    spans = rows.repartition(buckets, key, SLICE).withColumn(UNTIL, F.lead(SINCE).over(w)).where(F.col(UNTIL).isNull() | (F.col(UNTIL) > F.col(SINCE))).drop("_created")
    spans.write.mode("overwrite").bucketBy(buckets, key, SLICE).sortBy(key, SLICE, SINCE).option("path", path).saveAsTable(table)


def asof_history(spine: DataFrame, table: str, columns: Sequence[str], ttl: str, key: str = "symbol", time: str = "event_timestamp", unit: str = "month") -> DataFrame:
    """As ``pointintime.asof`` with a history of ``write_history``, which is neither shuffled nor sorted over a key's whole time."""
    f = spine.sparkSession.table(table).select(F.col(key).alias("_k"), F.col(SLICE).alias("_s"), SINCE, UNTIL, F.struct(*columns, F.col(SINCE).alias("feature_timestamp")).alias("_f"))
    s = spine.withColumn(SLICE, slice_of(F.col(time), unit))
    met = (F.col(key) == F.col("_k")) & (F.col(SLICE) == F.col("_s")) & (F.col(time) >= F.col(SINCE)) & (F.col(UNTIL).isNull() | (F.col(time) < F.col(UNTIL)))
    valid = F.col("_f.feature_timestamp") >= F.col(time) - F.expr(f"interval {ttl}")
    return s.join(f, met, "left").select(*spine.columns, *[F.when(valid, F.col("_f")[c]).alias(c) for c in [*columns, "feature_timestamp"]])


def write_online(online: DataFrame, table: str, path: str, buckets: int = 16, key: str = "symbol") -> None:
    online.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def look_up(spark: SparkSession, table: str, keys: Sequence[str], key: str = "symbol") -> DataFrame:
    """The asked keys with their online rows; missing tells which have none. Only the buckets of the keys are read."""
    asked = spark.createDataFrame([(k,) for k in keys], f"{key} string")
    rows = spark.table(table).where(F.col(key).isin(list(keys))).withColumn("_hit", F.lit(True))
    return F.broadcast(asked).join(rows, key, "left").withColumn("missing", F.col("_hit").isNull()).drop("_hit") if keys else spark.table(table).limit(0).withColumn("missing", F.lit(False))
