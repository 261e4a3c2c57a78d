"""Releases: a session's completion, history backfills and publication."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickspark.operators.bars import LOOKBACK, bounded_history, ohlcv, rolling
from tickspark.operators.coverage import content_digest, qualify_sessions, tick_coverage
from tickspark.operators.pointintime import materialise
from tickspark.operators.quality import frame_rules, violation_counts
from tickspark.operators.release import KEYS, insert_if_absent, overlap_conflicts, publication_checks, sliding_snapshot
from tickspark.sources.tables import Ledger, VersionedTable, exists


class Refused(ValueError):
    """A release or publication that its evidence doesn't allow."""


def session_features(bars: DataFrame, opening: Column, closing: Column, lookback: int = LOOKBACK) -> DataFrame:
    """Rolling features of the session's bars, from bounded history."""
    f = rolling(bounded_history(bars, opening, closing, lookback), ("avg_close", "volatility_close"), lookback)
    f = f.where((F.col("window_start") >= opening) & F.col("rolling_volatility_close").isNotNull())
    return f.withColumns({"event_timestamp": F.col("window_end"), "total_volume": F.col("total_volume").cast("long")})


def history_features(bars: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """Features of a whole history, warm-up rows dropped."""
    f = rolling(bars, ("avg_close", "volatility_close"), lookback).where("rolling_volatility_close is not null")
    return f.withColumns({"event_timestamp": F.col("window_end"), "total_volume": F.col("total_volume").cast("long")})


def failed(evidence: DataFrame) -> int:
    return evidence.where(~F.col("passed")).count()


def complete_session(trades: DataFrame, past: DataFrame, session: DataFrame, symbols: list[str], path: str, dataset_id: str, check_ticks: bool = True) -> str:
    """Bars, proof, features and the manifest of one session (one calendar row); writes an immutable release.

    The bars are computed anew from the trades, since a stream never emits the last window. Returns the release's folder."""
    spark = trades.sparkSession
    s = session.first()  # one row
    opening, closing = F.lit(s.market_open), F.lit(s.market_close)
    bars = ohlcv(trades.where((F.col("event_time") >= opening) & (F.col("event_time") < closing)))
    evidence = qualify_sessions(bars, session, symbols)
    if failed(evidence):
        raise Refused("the session's bars are incomplete")
    if check_ticks and failed(tick_coverage(trades, session)):
        raise Refused("the session's trades have gaps")
    features = session_features(past.unionByName(bars), opening, closing)
    broken = violation_counts(features, frame_rules()).where("violations > 0")
    if not broken.isEmpty():
        raise Refused(f"feature rows break rules: {[r.rule for r in broken.collect()]}")
    folder = f"{path}/{dataset_id}"
    bars.write.mode("errorifexists").parquet(f"{folder}/bars")
    features.write.mode("errorifexists").parquet(f"{folder}/features")
    write_manifest(spark, folder, dataset_id, historical=False)
    return folder


def backfill(bars: DataFrame, sess: DataFrame, symbols: list[str], path: str) -> str:
    """A historical release whose id is its content's digest; a second run finds it and changes nothing."""
    if failed(qualify_sessions(bars, sess, symbols)):
        raise Refused("the history is incomplete")
    dataset_id = "h" + content_digest(bars).first().digest[:24]
    folder = f"{path}/{dataset_id}"
    if not exists(bars.sparkSession, f"{folder}/manifest"):
        history_features(bars).write.mode("overwrite").parquet(f"{folder}/features")
        write_manifest(bars.sparkSession, folder, dataset_id, historical=True)
    return folder


def write_manifest(spark: SparkSession, folder: str, dataset_id: str, historical: bool) -> None:
    """One JSON row, written after the data: what has no manifest is no release."""
    f = spark.read.parquet(f"{folder}/features")
    m = f.agg(F.count("*").alias("row_count"), F.min("event_timestamp").alias("min_event_time"), F.max("event_timestamp").alias("max_event_time"), F.array_sort(F.collect_set("symbol")).alias("symbols"))
    m.select(F.lit(dataset_id).alias("dataset_id"), F.lit(historical).alias("historical"), "*").coalesce(1).write.mode("errorifexists").json(f"{folder}/manifest")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All of them; ``release.of_session`` picks and orders those of a session."""
    return spark.read.json(f"{path}/*/manifest")


LEDGER = "dataset_id string, manifest string, status string, max_event_time timestamp_ntz, updated_at timestamp_ntz"


def history_rows(held: DataFrame, rows: DataFrame, payload: Sequence[str]) -> DataFrame:
    """The rows whose keys the history lacks; refused if a key that it holds has other values."""
    if not overlap_conflicts(held, rows, payload).isEmpty():
        raise Refused("the history differs from what is held; publish a range that does not overlap")
    return insert_if_absent(held, rows)


def content(manifest: Row) -> str:
    """A manifest as one text, equal for equal manifests."""
    return json.dumps(manifest.asDict(recursive=True), sort_keys=True, default=str)


def publish(release: str, offline: VersionedTable, ledger: Ledger, online: DataFrame, days: int = 180, history: VersionedTable | None = None, write_online: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Upserts a release into the offline table and returns the training snapshot and the new online view.

    Refused: an id whose manifest is not the one that the ledger has for it; a release beside a pending other; one older than a
    live release that is complete, or, if it wasn't begun before, older than the offline rows. The ledger goes from pending to
    complete, which it is only when ``write_online`` has taken the view; a release that is complete already is not applied
    again. A row's ``created_at``, where the table has it, is the time of this publication. A historical release only adds rows
    to ``history``, a table of its own, is refused where it differs from rows there, and leaves the live rows and the online
    view as they are."""
    spark = offline.spark
    m = spark.read.json(f"{release}/manifest").first()
    newest = F.lit(m.max_event_time).cast("timestamp_ntz")
    state, manifest = ledger.latest("dataset_id"), content(m)
    before = state.where(F.col("dataset_id") == m.dataset_id).first()
    if before is not None and before.manifest != manifest:
        raise Refused(f"the id {m.dataset_id} was published with another manifest")
    checks = publication_checks(state, F.lit(m.dataset_id), newest).first()
    features = spark.read.parquet(f"{release}/features")
    if features.count() != m.row_count:
        raise Refused("the release's rows are not what its manifest says")
    stamp = spark.range(1).select(newest.alias("t"), F.current_timestamp().cast("timestamp_ntz").alias("now")).first()
    if not checks.already_complete and checks.others_pending:
        raise Refused("another publication is pending")
    if m.historical:
        if history is None:
            raise Refused("a historical release needs the table of histories")
        if not checks.already_complete:
            names = [f.name for f in history.schema.fields if f.name in features.columns]
            new = history_rows(history.read(), features.select(*names), [c for c in names if c not in KEYS])
            history.append(lineage(new, history, m.dataset_id))
            ledger.record(m.dataset_id, manifest, "complete", stamp.t, stamp.now)
        return history.read(), online
    if not checks.already_complete:
        if checks.newer_complete:
            raise Refused("a newer release is complete")
        if before is None:
            held = offline.read().agg(F.max("event_timestamp").cast("timestamp_ntz").alias("t")).first().t
            if held is not None and held > stamp.t:
                raise Refused("the offline rows are newer than the release")
            ledger.record(m.dataset_id, manifest, "pending", stamp.t, stamp.now)
        rows = features.select(*[f.name for f in offline.schema.fields if f.name in features.columns])
        offline.upsert(lineage(rows, offline, m.dataset_id))
    state = ledger.latest("dataset_id").withColumn("status", F.when(F.col("dataset_id") == m.dataset_id, "complete").otherwise(F.col("status")))
    snapshot = sliding_snapshot(offline.read(), state, days)
    columns = [c for c in online.columns if c not in ("symbol", "event_timestamp")]
    view = materialise(online, snapshot, newest - F.expr(f"interval {days} days"), newest, columns)
    if not checks.already_complete:
        if write_online is not None:
            write_online(view)
        ledger.record(m.dataset_id, manifest, "complete", stamp.t, stamp.now)
    return snapshot, view


def lineage(rows: DataFrame, table: VersionedTable, dataset_id: str) -> DataFrame:
    """``rows`` with the release that they came with and, where the table has it, when they were published."""
    out = rows.withColumn("dataset_version", F.lit(dataset_id))
    kinds = {f.name: f.dataType for f in table.schema.fields}
    return out.withColumn("created_at", F.current_timestamp().cast(kinds["created_at"])) if "created_at" in kinds else out


def recheck(release: str, session: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The evidence of a saved release, computed again and nothing published: one row with what its manifest says and whether its
    rows still bear it out."""
    spark = session.sparkSession
    m = spark.read.json(f"{release}/manifest")
    f = spark.read.parquet(f"{release}/features").agg(F.count("*").alias("rows"), F.min("event_timestamp").cast("string").alias("first"), F.max("event_timestamp").cast("string").alias("last"))
    bars = qualify_sessions(spark.read.parquet(f"{release}/bars"), session, symbols).agg(F.coalesce(F.min("passed"), F.lit(False)).alias("bars_complete"))
    said = m.select("dataset_id", "row_count", F.col("min_event_time").cast("timestamp_ntz").cast("string").alias("_a"), F.col("max_event_time").cast("timestamp_ntz").cast("string").alias("_b"))
    one = said.crossJoin(f).crossJoin(bars)  # one row each
    agrees = (F.col("rows") == F.col("row_count")) & F.col("first").eqNullSafe(F.col("_a")) & F.col("last").eqNullSafe(F.col("_b"))
    return one.select("dataset_id", "row_count", "rows", agrees.alias("manifest_agrees"), "bars_complete", (agrees & F.col("bars_complete")).alias("qualified"))
