"""Publication: upserts, anti-inserts, snapshots, conflicts and the ledger."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("symbol", "window_start")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All updates, and the target's rows with other keys; columns that only one side has become null on the other."""
    return updates.unionByName(target.join(updates.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def insert_if_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The updates whose keys the target lacks."""
    return updates.join(target.select(*keys), list(keys), "left_anti")


def newer_rows(updates: DataFrame, target: DataFrame, key: str = "symbol", time: str = "window_start") -> DataFrame:
    """Rows after the highest time that the target holds of their key; all rows of new keys."""
    marks = target.groupBy(key).agg(F.max(time).alias("_mark"))
    return updates.join(marks, key, "left").where(F.col("_mark").isNull() | (F.col(time) > F.col("_mark"))).drop("_mark")


def sliding_snapshot(rows: DataFrame, ledger: DataFrame, days: int, time: str = "event_timestamp", lineage: str = "dataset_version") -> DataFrame:
    """Rows of complete releases in the ``days`` up to the newest of them."""
    complete = ledger.where("status = 'complete'").select(F.col("dataset_id").alias(lineage)).distinct()
    held = rows.join(complete, lineage, "left_semi")
    newest = held.agg(F.max(time).alias("_newest"))  # one row
    return held.crossJoin(F.broadcast(newest)).where(F.col(time) >= F.col("_newest") - F.expr(f"interval {days} days")).drop("_newest")


def legacy_snapshot(snapshot: DataFrame, rows: DataFrame, now: Column, days: int, keys: Sequence[str] = ("symbol", "event_timestamp")) -> DataFrame:
    """Expires rows older than ``days`` and adds distinct recent ones whose keys are new."""
    since = now - F.expr(f"interval {days} days")
    kept = snapshot.where(F.col(keys[-1]) >= since)
    fresh = rows.where(F.col(keys[-1]) >= since).distinct()
    return kept.unionByName(insert_if_absent(kept, fresh, keys), allowMissingColumns=True)


def is_historical(manifest: str = "manifest") -> Column:
    """Whether a manifest says that its release fills the past."""
    return F.coalesce(F.get_json_object(manifest, "$.historical").cast("boolean"), F.lit(False)) | F.get_json_object(manifest, "$.historical_source").isNotNull()


def latest_publication(ledger: DataFrame) -> DataFrame:
    """The newest complete release that isn't historical, by time and then by update."""
    live = ledger.where("status = 'complete'").where(~is_historical())
    return live.agg(F.max_by("dataset_id", F.struct("max_event_time", "updated_at")).alias("dataset_id"), F.max("max_event_time").alias("max_event_time"))


def overlap_conflicts(target: DataFrame, updates: DataFrame, payload: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that both hold with different payloads, nulls compared as values."""
    t, u = target.alias("t"), updates.alias("u")
    both = t.join(u, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys])
    differs = reduce(Column.__or__, [~F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in payload])
    return both.where(differs).select(*[F.col(f"t.{k}").alias(k) for k in keys])


def deadline(latest: DataFrame, sess: DataFrame, now: Column, delay: str = "60 minutes") -> DataFrame:
    """``latest`` (symbol, latest) with required_close, the last one due, and whether it is met."""
    due = sess.where(F.col("market_close") + F.expr(f"interval {delay}") <= now).agg(F.max("market_close").alias("required_close"))
    return latest.crossJoin(F.broadcast(due)).withColumn("met", F.col("latest") >= F.col("required_close"))


def publication_checks(ledger: DataFrame, dataset_id: Column, max_event_time: Column) -> DataFrame:
    """One row of counts that refuse a publication: the same id complete, another id pending, an id listed twice, newer data of
    releases that aren't historical."""
    same, complete = F.col("dataset_id") == dataset_id, F.col("status") == "complete"
    return ledger.agg(
        F.count_if(same & complete).alias("already_complete"), F.count_if(~same & (F.col("status") == "pending")).alias("others_pending"),
        F.coalesce(F.sum(same.cast("int")) > 1, F.lit(False)).alias("listed_twice"), F.count_if(~same & complete & ~is_historical() & (F.col("max_event_time") > max_event_time)).alias("newer_complete"),
    )


def by_priority(rows: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """One row a key from several sources, the earlier source first."""
    tagged = [r.withColumn("_priority", F.lit(i)) for i, r in enumerate(rows)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return union.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("_priority"))).where("_r = 1").drop("_r", "_priority")


def month_partitions(span: DataFrame) -> DataFrame:
    """The months that (first, last) reaches into: partition, since and until (exclusive)."""
    month = F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))
    m = span.select(F.explode(month).alias("since"))
    return m.select(F.date_format("since", "yyyy-MM").alias("partition"), "since", F.add_months("since", 1).alias("until"))


def canonical_path(path: str) -> str:
    """One scheme and no empty, current or parent steps, so that equal places have equal names."""
    scheme, _, rest = path.replace("s3a://", "s3://").replace("s3n://", "s3://").rpartition("://")
    parts = [p for p in rest.split("/") if p not in ("", ".")]
    if ".." in parts:
        raise ValueError("a release's path must not climb")
    return f"{scheme}://{'/'.join(parts)}" if scheme else ("/" if rest.startswith("/") else "") + "/".join(parts)


def manifest_problems(manifests: DataFrame) -> DataFrame:
    """(dataset_id, problem): times out of order, a close before the newest row, no rows, an id listed with different contents."""
    found = F.array(
        F.when(F.col("min_event_time") > F.col("max_event_time"), "times_out_of_order"),
        F.when(F.col("max_event_time") > F.col("market_close"), "rows_after_the_close"),
        F.when(F.coalesce(F.col("row_count"), F.lit(0)) <= 0, "no_rows"),
    )
    single = manifests.select("dataset_id", F.explode(F.array_compact(found)).alias("problem"))
    twice = manifests.groupBy("dataset_id").agg(F.count_distinct(F.struct("min_event_time", "max_event_time", "market_close", "row_count")).alias("_n")).where("_n > 1")
    return single.unionByName(twice.select("dataset_id", F.lit("id_reused").alias("problem"))).distinct()


def of_session(manifests: DataFrame, day: Column) -> DataFrame:
    """The manifests whose market close lies on a New York date, with order 1 for the newest completed."""
    mine = manifests.where(F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("market_close").cast("timestamp_ntz"))) == day)
    return mine.withColumn("order", F.row_number().over(W.orderBy(F.desc("completed_at"), "dataset_id")))  # a few a session


#: The policies under which a release may be trained on.
POLICIES = ("nyse-full-session-v1", "nyse-historical-bars-v1")


def ledger_rows(live: DataFrame, historical: DataFrame, ledger: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row a key from live and historical rows whose release is complete, qualified under a known policy, and unadjusted
    if it is historical; live rows first. The ledger has a row a release and is broadcast."""
    m = F.col("manifest")
    adjustment = F.get_json_object(m, "$.historical_source.adjustment")
    fit = (F.col("status") == "complete") & F.get_json_object(m, "$.session_qualification.policy").isin(*POLICIES) & (F.get_json_object(m, "$.session_qualification.status") == "passed")
    fit = fit & (F.get_json_object(m, "$.historical_source").isNull() | (adjustment == "unadjusted"))
    ids = F.broadcast(ledger.where(fit).select(F.col("dataset_id").alias("dataset_version")).distinct())
    return by_priority([live.join(ids, "dataset_version", "left_semi"), historical.join(ids, "dataset_version", "left_semi")], keys)
