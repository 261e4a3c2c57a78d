"""Jobs composed of the operators: the live session, features, loads, training data, reports and the universe."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import NumericType

from tickspark.operators import calendar, coverage, drift, evaluation, quality, training, universe
from tickspark.operators.release import ledger_rows, newer_rows
from tickspark.schemas import BAR
from tickspark.sources import tables, trades
from tickspark.sources.releases import Refused, complete_session, history_features
from tickspark.streaming import live


@dataclass
class LiveSession:
    """The queries of a live session and what they write."""

    queries: list[StreamingQuery]
    bronze: str
    dead: str
    gold: tables.VersionedTable
    metrics: live.MetricsTable
    listener: live.MetricsListener

    def close(self) -> None:
        """Detaches the listener, once it has heard of every batch."""
        spark = self.gold.spark
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(self.listener)


def live_session(source: DataFrame, folder: str, as_of: Column | None = None, trigger: dict | None = None, compact_every: int = 50, hours: float = live.RETENTION_HOURS) -> LiveSession:
    """Two queries with checkpoints of their own: trades, which one tagged batch deals to the valid and the rejected table, and
    bars of the stored valid trades. A batch's lateness is judged once, by the time that its offsets were logged with, or by
    ``as_of``, which may be a column with each row's arrival. A listener keeps a row of metrics a batch, rejections by reason
    among them. With an availableNow trigger the trades are finished before the bars start."""
    spark, trigger = source.sparkSession, trigger or {"processingTime": "30 seconds"}
    rules = quality.trade_rules(as_of)
    tagged = quality.observed(quality.tag(source, rules), list(rules))
    gold = tables.VersionedTable(spark, f"{folder}/gold", BAR).create_if_missing()
    bronze, dead, metrics = f"{folder}/bronze", f"{folder}/dead", live.MetricsTable(spark, f"{folder}/metrics")
    tables.make_folder(spark, bronze)
    listener = live.MetricsListener(metrics, {"trades", "gold"})
    spark.streams.addListener(listener)
    queries = [live.each_batch(tagged, live.split_writer(bronze, dead, as_of), f"{folder}/checkpoints/trades", trigger, "trades")]
    if "availableNow" in trigger:
        queries[0].awaitTermination()
    bars = live.bars_of(tables.stream(spark, bronze, source.schema, nested=True))
    queries.append(live.each_batch(bars, live.upsert_writer(gold, compact_every, "gold", hours), f"{folder}/checkpoints/gold", trigger, "gold", "update"))
    return LiveSession(queries, bronze, dead, gold, metrics, listener)


def finish_session(job: LiveSession, past: DataFrame, session: DataFrame, symbols: Sequence[str], path: str, dataset_id: str) -> str:
    """Drains the queries, then completes the session's release from the stored trades; a query that died prevents it."""
    live.drain(*job.queries)
    job.close()
    return complete_session(tables.scan(job.gold.spark, job.bronze), past, session, list(symbols), path, dataset_id)


def recovery_report(records: DataFrame, bounds: DataFrame, symbols: Sequence[str], most: int = 100_000_000) -> DataFrame:
    """One row about a replayed range: valid, rejected and identical rows, and whether every offset was read."""
    trades.bounded_replay(bounds, most)
    good, bad = trades.replay(records, symbols)
    same = quality.duplicate_payloads(good).agg(F.coalesce(F.sum("trades"), F.lit(0)).alias("valid_rows"), F.coalesce(F.sum("identical"), F.lit(0)).alias("identical_trade_payloads"))
    read = trades.reconcile(records, bounds).agg(F.sum("expected").alias("expected"), F.min("complete").alias("complete"))
    return same.crossJoin(bad.agg(F.count("*").alias("rejected_rows"))).crossJoin(read)  # one row each


def session_report(ticks: DataFrame, bars: DataFrame, session: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Per symbol of one session (one calendar row): trades, gaps over the limit, missing bars, and whether bars and trades
    qualify; nothing is published."""
    inside = coverage.in_session(ticks, session, "event_time").groupBy("symbol").agg(F.count("*").alias("trades"))
    gaps = coverage.trade_gaps(ticks, session, symbols).groupBy("symbol").agg(F.count("*").alias("gaps_over_limit"))
    missing = coverage.missing_bars(bars, session, symbols).groupBy("symbol").agg(F.count("*").alias("missing_bars"))
    good = coverage.qualify_sessions(bars, session, symbols).select("symbol", F.col("passed").alias("_bars"))
    ticked = coverage.tick_coverage(ticks, session).select("symbol", F.col("passed").alias("_ticks"))
    out = good
    for part in (inside, gaps, missing, ticked):
        out = out.join(part, "symbol", "left")
    out = out.fillna(0, ["trades", "gaps_over_limit", "missing_bars"])
    return out.withColumn("qualified", F.col("_bars") & F.coalesce("_ticks", F.lit(False))).drop("_bars", "_ticks")


def batch_features(spark: SparkSession, source: str, target: str, mode: str = "errorifexists") -> None:
    """Bars in a folder to features in another."""
    tables.write_features(history_features(tables.scan(spark, source)), target, mode)


def offline_table(spark: SparkSession, path: str, like: DataFrame) -> tables.VersionedTable:
    return tables.VersionedTable(spark, path, like.schema).create_if_missing()


def sketch_days(rows: DataFrame, path: str, columns: Sequence[str], time: str = "event_timestamp") -> None:
    """Adds the sketches of the days of ``rows`` to the table in ``path``; a day that is there already is replaced."""
    sketches = drift.period_sketches(rows, columns, time)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def drift_report(spark: SparkSession, path: str, now: Column, reference_days: int = 180, current_days: int = 30) -> DataFrame:
    """The drift decision of two periods, read from the table of sketches; no row of the history is read. Unequal symbols are refused."""
    sketches = spark.read.schema(drift.SKETCHED).parquet(path)
    return drift.sketch_decision(sketches, now, reference_days, current_days)


REQUIRED = {"symbol": "string", "window_start": "datetime", "close": "float", "total_volume": "int"}


def incremental_load(rows: DataFrame, path: str, required: dict[str, str] | None = None) -> int:
    """Adds what is newer than the table's rows of each symbol; rows that break the contract are refused before anything is
    written. Returns the table's version."""
    broken = quality.contract_violations(rows, REQUIRED if required is None else required)
    if broken:
        raise Refused(f"the rows break their contract: {broken}")
    table = offline_table(rows.sparkSession, path, rows)
    return table.append(newer_rows(rows, table.read()))


RUNS = "run_id string, version long, schema_version int, inserted long, newest timestamp_ntz"


@dataclass
class Load:
    """What a load did: the table's version, that of its rows' schema, and the rows it added."""

    version: int
    schema_version: int
    inserted: int


class LoadedTable:
    """A table that loads fill: rows in months, the schemas it was given, and a row a load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schemas, self.runs = tables.SchemaLedger(spark, f"{path}/schemas"), tables.Ledger(spark, f"{path}/runs", RUNS)

    def rows(self) -> tables.VersionedTable:
        return tables.VersionedTable(self.spark, f"{self.path}/rows", self.schemas.schema("rows")).create_if_missing()

    def load(self, rows: DataFrame, run_id: str, required: dict[str, str] | None = None) -> Load:
        """Adds what is newer than the table's rows of each symbol.

        Rows that break the contract are refused before anything is written. Numbers are filled forward in each symbol and then
        backward over the rows in order, as ``impute`` does globally, before the newer ones are picked. Columns that the table
        lacks are added to it, its older rows have nulls there; columns that the rows lack are null; a column that both have
        keeps the table's type. A load that comes again, or that died before it was recorded, adds nothing twice."""
        broken = quality.contract_violations(rows, REQUIRED if required is None else required)
        if broken:
            raise Refused(f"the rows break their contract: {broken}")
        if "event_timestamp" not in rows.columns:
            rows = rows.withColumn("event_timestamp", F.col("window_start"))
        filled = quality.impute(rows, [f.name for f in rows.schema.fields if isinstance(f.dataType, NumericType)], order="window_start", backfill="global")
        schema_version = self.schemas.record("rows", rows)
        table = self.rows()
        kinds = {f.name: f.dataType for f in table.schema.fields}
        shaped = filled.select(*[(F.col(n) if n in filled.columns else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])
        version = table.append(newer_rows(shaped, table.read()))
        new = table.added(version).agg(F.count("*").alias("n"), F.max("window_start").cast("timestamp_ntz").alias("newest")).first()
        self.runs.record(run_id, version, schema_version, new.n, new.newest)
        return Load(version, schema_version, new.n)


def training_frame(live_rows: DataFrame, historical: DataFrame, ledger: DataFrame, symbols: Sequence[str], now: Column, days: int = 180, least: int = 60) -> DataFrame:
    """The model frame of the last ``days``: rows of complete, qualified releases, live ones before historical ones of the same
    key. Refused if it would be empty, or if a listed symbol has rows on fewer than ``least`` New York dates (one without rows has
    0); rows of other symbols are left out."""
    kept = ledger_rows(live_rows, historical, ledger)
    kept = kept.where(F.col("symbol").isin(list(symbols)) & (F.col("event_timestamp") >= now - F.expr(f"interval {days} days")) & (F.col("event_timestamp") <= now))
    found = {r.symbol: r.sessions for r in training.min_history(kept, least).collect()}  # a row a listed symbol
    if not found:
        raise Refused("no row belongs to a complete, qualified release")
    if short := {s: found.get(s, 0) for s in symbols if found.get(s, 0) < least}:
        raise Refused(f"symbols with fewer than {least} sessions: {short}")
    return training.model_frame(kept)


@dataclass
class Forecast:
    """A row a symbol and step, and a row a symbol."""

    steps: DataFrame
    summary: DataFrame


def batch_forecast(predictions: DataFrame, offsets: DataFrame, history: DataFrame, sess: DataFrame, horizon: int, decoder: int = 39, time: str = "event_timestamp") -> Forecast:
    """Calibrated price paths of all symbols at once, with the times of their bars.

    predictions: (symbol, horizon, quantile, y_pred) log returns of a whole decoder; offsets: ``residual_offsets``; the base price
    is the symbol's last close. Paths and times are resolved for the whole decoder and then cut to ``horizon`` steps, so the
    first step has the first time. Refused, when rows are read: a decoder that isn't whole, no base price, no offset or no time
    for a step (the sessions end too early)."""
    if not 1 <= horizon <= decoder:
        raise ValueError("the horizon must lie within the decoder")
    last = history.groupBy("symbol").agg(F.max(time).alias(time), F.max_by("close", time).alias("base_price"))
    times = calendar.future_bars(last, sess, decoder).select("symbol", F.col("step").alias("horizon"), time)
    paths = predictions.withColumnRenamed("symbol", "sample_id")
    base = last.select(F.col("symbol").alias("sample_id"), "base_price")
    table = evaluation.price_table(evaluation.price_paths(paths, offsets, base), base).drop("base_price").withColumnRenamed("sample_id", "symbol")
    whole = predictions.groupBy("symbol").agg((F.count_distinct("horizon", "quantile") == decoder * F.count_distinct("quantile")).alias("_a"), (F.count("*") == decoder * F.count_distinct("quantile")).alias("_b"), F.min("horizon").alias("_c"), F.max("horizon").alias("_d"))
    whole = whole.select("symbol", (F.col("_a") & F.col("_b") & (F.col("_c") == 1) & (F.col("_d") == decoder)).alias("_whole"))
    asked = whole.join(last.select("symbol", "base_price"), "symbol", "left").withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(decoder))))
    met = asked.join(table, ["symbol", "horizon"], "left").join(times, ["symbol", "horizon"], "left")
    problem = F.when(~F.col("_whole"), "the decoder of a symbol isn't whole").when(F.col("base_price").isNull(), "a symbol has no base price").when(F.col(time).isNull(), "the sessions end before the decoder")
    problem = problem.when(F.col("p10").isNull() | F.col("p50").isNull() | F.col("p90").isNull(), "a step has no calibrated price")
    of_symbol = F.max(problem).over(W.partitionBy("symbol"))  # all steps of the decoder are checked, whatever is returned
    checked = met.withColumn("_problem", of_symbol).withColumn("_ok", F.when(F.col("_problem").isNotNull(), F.raise_error(F.col("_problem")).cast("boolean")).otherwise(True)).where("_ok")
    steps = checked.where(F.col("horizon") <= horizon).select("symbol", F.col("horizon").alias("step"), time, "p10", "p50", "p90", "base_price")
    end = steps.where(F.col("step") == horizon)
    change = F.round(F.col("p50") - F.col("base_price"), 4) + 0.0  # no negative zero
    percent = F.round(F.coalesce(F.try_divide(F.col("p50") - F.col("base_price"), "base_price"), F.lit(0.0)), 4) + 0.0
    rounded = [F.round(p, 4).alias(p) for p in ("p10", "p50", "p90")]
    return Forecast(steps.select("symbol", "step", time, *rounded), end.select("symbol", F.lit(horizon).alias("horizon"), F.round("base_price", 4).alias("base_price"), change.alias("absolute_change"), percent.alias("percent_change")))


@dataclass
class TrainingDataset:
    """What a training run reads: both sides of the split, the boundaries, the decoder windows and the cutoff (one row)."""

    train: DataFrame
    validation: DataFrame
    boundaries: DataFrame
    windows: DataFrame
    cutoff: DataFrame


def training_dataset(rows: DataFrame, columns: Sequence[str], ratio: float = 0.2, encoder: int = 780, horizon: int = 39, every_group: bool = True, time: str = "event_timestamp") -> TrainingDataset:
    """Rows with finite values, split by time, with decoder windows that are checked: none of those in the holdout reaches back
    over the cutoff, and (``every_group``) each symbol has some."""
    kept = quality.drop_non_finite(rows, columns)
    train, validation, boundaries = training.temporal_split(kept, ratio, encoder, horizon, time)
    windows = training.decoder_index(validation, boundaries, encoder, horizon)
    cut = training.cutoff(kept, ratio, time)
    held = windows.where("in_holdout")
    if not training.leaks(held, validation, cut, time).isEmpty():
        raise Refused("decoder windows reach back over the cutoff")
    if every_group and not training.groups_without_windows(kept, held).isEmpty():
        raise Refused("symbols without a window in the holdout")
    return TrainingDataset(train, validation, boundaries, windows, cut)


def universe_refresh(previous: DataFrame, candidate: DataFrame, folder: str, run_id: str, fetched_at: Column, least: int = universe.LEAST, most: int = universe.MOST, limit: float = universe.CHURN) -> DataFrame:
    """One row: members, added, removed, churn, and whether the candidate passed its checks and was published."""
    cleaned = universe.clean(candidate)
    checks, moved = universe.candidate_checks(cleaned, least, most), universe.churn(previous, cleaned, limit)
    both = checks.crossJoin(moved).withColumn("published", F.col("passed") & F.col("accepted"))  # one row each
    if both.first().published:
        universe.export(cleaned.select(*universe.COLUMNS), folder, run_id, fetched_at)
    return both.select("members", "added", "removed", "churn", "published")
