from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import bars as B
from tickspark.operators import calendar as C
from tickspark.operators import universe as U
from tickspark.schemas import BAR
from tickspark.sources import releases as R
from tickspark.sources.tables import Ledger, VersionedTable, evolve, schema_fingerprint, workspace
from tickspark.streaming import live


def bars(spark, months, close=1.0):
    rows = [("A", datetime(2024, m, 1), datetime(2024, m, 1, 0, 30), close, close, close, close, 1.0) for m in months]
    return spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, close double, total_volume double").select([f.name for f in BAR.fields])


def test_versions_upsert_and_expiry(spark):
    t = VersionedTable(spark, workspace(spark, "t"), BAR).create_if_missing().create_if_missing()
    assert t.read().isEmpty() and t.version() == 0
    t.upsert(bars(spark, [1, 2]))
    kept = t.folders()["2024-01"]
    t.upsert(bars(spark, [2, 3], 5.0))
    assert t.folders()["2024-01"] == kept  # untouched partitions aren't rewritten
    assert sorted(r.close for r in t.read().collect()) == [1.0, 5.0, 5.0]
    assert sorted(r.close for r in t.read(1).collect()) == [1.0, 1.0]
    t.upsert(bars(spark, [2, 3], 5.0))
    assert t.read().count() == 3
    t.append(bars(spark, [4]))
    t.compact()
    assert t.read().count() == 4 and t.expire(keep=1) and t.read().count() == 4


def test_fingerprint_and_evolution(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("x", 1)], "b string, a int")
    assert schema_fingerprint(a) == schema_fingerprint(b) != schema_fingerprint(a.withColumn("c", F.lit(1)))
    assert evolve(a, b.withColumn("c", F.lit(1.0))).dtypes == [("a", "int"), ("b", "string"), ("c", "double")]


def test_release_publication_retry_and_refusal(spark):
    w = workspace(spark, "release")
    days = C.sessions(spark.createDataFrame([(date(2026, 9, 28), date(2026, 9, 29))], "first_day date, last_day date"))
    rows = [(s, datetime(2026, 9, d, 13, 30) + timedelta(minutes=i), 100.0 + i // 30, 1) for d in (28, 29) for s in "AB" for i in range(390)]
    trades = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, price double, volume long")
    one, two = (days.where(F.col("session_date") == F.lit(f"2026-09-{d}").cast("date")) for d in (28, 29))
    first = trades.where(F.dayofmonth("event_time") == 28)
    release1 = R.complete_session(first, B.ohlcv(first).limit(0), one, ["A", "B"], w, "r1")
    release2 = R.complete_session(trades, B.ohlcv(first), two, ["A", "B"], w, "r2")
    assert spark.read.parquet(f"{release1}/features").count() == 24 and spark.read.parquet(f"{release2}/features").count() == 26
    assert {r.dataset_id for r in R.manifests(spark, w).collect()} == {"r1", "r2"}
    with pytest.raises(R.Refused):
        R.complete_session(trades.where("symbol = 'A'"), B.ohlcv(first), two, ["A", "B"], w, "r3")
    schema = spark.read.parquet(f"{release1}/features").withColumn("dataset_version", F.lit("")).schema
    offline, ledger = VersionedTable(spark, f"{w}/offline", schema).create_if_missing(), Ledger(spark, f"{w}/ledger", R.LEDGER)
    online = spark.createDataFrame([], "symbol string, event_timestamp timestamp_ntz, close double")
    snapshot, online2 = R.publish(release2, offline, ledger, online)
    assert snapshot.count() == 26 and online2.count() == 2
    version = offline.version()
    R.publish(release2, offline, ledger, online)
    assert offline.version() == version
    with pytest.raises(R.Refused):
        R.publish(release1, offline, ledger, online)


def test_backfill_is_resumed_not_repeated(spark):
    w = workspace(spark, "backfill")
    days = C.sessions(spark.createDataFrame([(date(2026, 9, 28), date(2026, 9, 28))], "first_day date, last_day date"))
    rows = [("A", datetime(2026, 9, 28, 13, 30) + timedelta(minutes=30 * i), datetime(2026, 9, 28, 14) + timedelta(minutes=30 * i), 1.0 + i, 1.0 + i, 1.0 + i, 1.0 + i, 5.0) for i in range(13)]
    b = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open double, high double, low double, close double, total_volume double")
    assert R.backfill(b, days, ["A"], w) == R.backfill(b.orderBy(F.desc("window_start")), days, ["A"], w)
    with pytest.raises(R.Refused):
        R.backfill(b.limit(12), days, ["A"], w)


def test_a_restarted_stream_adds_no_duplicates(spark):
    w = workspace(spark, "restart")
    rows = [("A", 1.0, 1.0, 1_700_000_000_000 + 1000 * i) for i in range(20)]
    spark.createDataFrame(rows, "symbol string, price double, volume double, timestamp long").withColumn("event_time", F.timestamp_millis("timestamp")).write.parquet(f"{w}/in")
    for _ in range(2):
        s = spark.readStream.schema("symbol string, price double, volume double, timestamp long, event_time timestamp").parquet(f"{w}/in")
        live.each_batch(s, live.split_writer(f"{w}/bronze", f"{w}/dead", F.lit("2023-01-01").cast("timestamp")), f"{w}/cp", {"availableNow": True}, "split").awaitTermination()
    assert spark.read.parquet(f"{w}/bronze").count() == 20


def test_a_failing_handler_fails_the_batch(spark):
    w = workspace(spark, "handler")
    spark.range(3).select(F.lit("A").alias("symbol"), F.lit(1.0).alias("price"), F.lit(1.0).alias("volume"), F.lit(1).cast("long").alias("timestamp"), F.current_timestamp().alias("event_time")).write.parquet(f"{w}/in")
    s = spark.readStream.schema("symbol string, price double, volume double, timestamp long, event_time timestamp").parquet(f"{w}/in")

    def fail(batch, batch_id):
        raise RuntimeError("no")

    q = live.each_batch(s, live.split_writer(f"{w}/b", f"{w}/d", None, [fail]), f"{w}/cp", {"availableNow": True}, "failing")
    with pytest.raises(Exception, match="no"):
        q.awaitTermination()


def test_universe_is_verified_and_refused_when_changed(spark):
    rows = [(f"S{i}", f"n{i}", "x") for i in range(460)]
    c = U.clean(spark.createDataFrame(rows, "symbol string, company_name string, sector string"))
    assert U.candidate_checks(c).first().passed
    m = U.artifact_digest(c)
    assert U.verify(c, m).first().intact and not U.verify(c.where("symbol <> 'S1'"), m).first().intact
    assert U.churn(c, c.where("symbol >= 'S2'")).first().accepted is False


def test_a_history_adds_rows_is_refused_where_it_differs_and_leaves_the_online_view(spark):
    w = workspace(spark, "history")
    days = C.sessions(spark.createDataFrame([(date(2026, 9, 28), date(2026, 9, 29))], "first_day date, last_day date"))
    rows = [("A", datetime(2026, 9, d, 13, 30) + timedelta(minutes=30 * i), datetime(2026, 9, d, 14) + timedelta(minutes=30 * i), *[float(d + i % 3)] * 4, 5.0) for d in (28, 29) for i in range(13)]
    b = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open double, high double, low double, close double, total_volume double")
    release = R.backfill(b, days, ["A"], w)
    schema = spark.read.parquet(f"{release}/features").withColumn("dataset_version", F.lit("")).schema
    live_table, history = (VersionedTable(spark, f"{w}/{n}", schema).create_if_missing() for n in ("live", "history"))
    ledger = Ledger(spark, f"{w}/ledger", R.LEDGER)
    online = spark.createDataFrame([("A", datetime(2026, 1, 1), 1.0)], "symbol string, event_timestamp timestamp_ntz, close double")
    with pytest.raises(R.Refused):
        R.publish(release, live_table, ledger, online)
    rows_, view = R.publish(release, live_table, ledger, online, history=history)
    assert rows_.count() == spark.read.parquet(f"{release}/features").count() and view.collect() == online.collect() and live_table.read().isEmpty()
    version = history.version()
    R.publish(release, live_table, ledger, online, history=history)
    assert history.version() == version
    changed = R.backfill(b.withColumns({c: F.col(c) + 1 for c in ("open", "high", "low", "close")}), days, ["A"], w)
    with pytest.raises(R.Refused):
        R.publish(changed, live_table, ledger, online, history=history)


def test_each_refusal_of_a_publication(spark):
    w = workspace(spark, "refusals")
    rows = [("A", datetime(2024, 1, d), datetime(2024, 1, d, 0, 30), float(d)) for d in range(2, 12)]
    f = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, event_timestamp timestamp_ntz, close double")

    def made(name, dataset_id, part, historical=False):
        part.write.parquet(f"{w}/{name}/features")
        R.write_manifest(spark, f"{w}/{name}", dataset_id, historical=historical)
        return f"{w}/{name}"

    def upto(day):
        return f.where(F.dayofmonth("event_timestamp") <= day)

    schema = f.withColumns({"dataset_version": F.lit(""), "created_at": F.current_timestamp()}).schema
    offline, history = (VersionedTable(spark, f"{w}/{n}", schema).create_if_missing() for n in ("offline", "history"))
    ledger = Ledger(spark, f"{w}/ledger", R.LEDGER)
    online = spark.createDataFrame([], "symbol string, event_timestamp timestamp_ntz, close double")
    past = made("past", "h1", f, historical=True)
    R.publish(past, offline, ledger, online, history=history)  # reaches past the live release below and doesn't hinder it

    def broken(view):
        raise RuntimeError("no view")

    first = made("first", "r1", upto(5))
    with pytest.raises(RuntimeError):
        R.publish(first, offline, ledger, online, write_online=broken)
    assert ledger.latest("dataset_id").where("dataset_id = 'r1'").first().status == "pending"  # not complete without its view
    with pytest.raises(R.Refused, match="pending"):
        R.publish(made("beside", "r2", upto(8)), offline, ledger, online)
    seen = []
    R.publish(first, offline, ledger, online, write_online=lambda v: seen.append(v.count()))
    assert seen == [1] and ledger.latest("dataset_id").where("dataset_id = 'r1'").first().status == "complete"
    with pytest.raises(R.Refused, match="another manifest"):
        R.publish(made("reused", "r1", upto(7)), offline, ledger, online)
    with pytest.raises(R.Refused, match="newer release"):
        R.publish(made("older", "r0", upto(3)), offline, ledger, online)
    offline.upsert(f.where("symbol = 'A'").withColumns({"dataset_version": F.lit("elsewhere"), "created_at": F.current_timestamp()}))
    with pytest.raises(R.Refused, match="offline rows are newer"):
        R.publish(made("behind", "r3", upto(6)), offline, ledger, online)
    assert offline.read().where("created_at is null").isEmpty()


def test_a_saved_release_is_checked_again(spark):
    w = workspace(spark, "recheck")
    day = C.sessions(spark.createDataFrame([(date(2026, 9, 28), date(2026, 9, 28))], "first_day date, last_day date"))
    rows = [(s, datetime(2026, 9, 28, 13, 30) + timedelta(minutes=i), 100.0 + i // 30, 1) for s in "AB" for i in range(390)]
    trades = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, price double, volume long")
    release = R.complete_session(trades, B.ohlcv(trades).limit(0), day, ["A", "B"], w, "r1")
    assert R.recheck(release, day, ["A", "B"]).first().qualified and not R.recheck(release, day, ["A", "B", "C"]).first().bars_complete
    spark.read.parquet(f"{release}/features").limit(1).write.mode("append").parquet(f"{release}/features")
    assert not R.recheck(release, day, ["A", "B"]).first().manifest_agrees


def test_retention_by_hours_keeps_recent_versions(spark):
    t = VersionedTable(spark, workspace(spark, "hours"), BAR).create_if_missing()
    for close in (1.0, 2.0, 3.0):
        t.upsert(bars(spark, [1], close))
    assert t.expire(keep=1, hours=1) == [] and t.read(1).count() == 1
    assert len(t.expire(keep=1, hours=0)) >= 1 and t.read().first().close == 3.0


def test_a_changed_schema_is_a_new_version(spark):
    from tickspark.sources.tables import SchemaLedger

    a = spark.createDataFrame([(1, "x")], "a int, b string")
    s = SchemaLedger(spark, f"{workspace(spark, 'schema')}/ledger")
    assert [s.record("t", a), s.record("t", a), s.record("t", a.withColumn("c", F.lit(1))), s.record("u", a)] == [1, 1, 2, 1]


def test_paths_and_replay_bounds(spark):
    from tickspark.operators.release import canonical_path
    from tickspark.sources.trades import bounded_replay, kafka_options

    assert canonical_path("s3a://bucket//a/./b/") == "s3://bucket/a/b" and canonical_path("/x//y") == "/x/y"
    with pytest.raises(ValueError):
        canonical_path("s3://bucket/../b")
    b = spark.createDataFrame([(0, 5, 10), (1, 0, 3)], "partition int, start long, end_exclusive long")
    assert bounded_replay(b, 8) == 8
    with pytest.raises(ValueError):
        bounded_replay(b, 7)
    assert kafka_options("h:1", "t")["maxOffsetsPerTrigger"] == "50000"


def test_lag_is_the_sum_over_partitions(spark):
    source = {"latestOffset": '{"t": {"0": 10, "1": 7}}', "endOffset": {"t": {"0": 4, "1": 9}}}
    assert live.partition_lag(source) == 6 and live.partition_lag({"latestOffset": None, "endOffset": "12"}) == 0
    p = {"name": "q", "batchId": 3, "numInputRows": 5, "durationMs": {"triggerExecution": 12}, "sources": [source], "inputRowsPerSecond": 2.5, "processedRowsPerSecond": float("nan")}
    assert live.progress_metrics(p) == ("q", 3, 5, 12, 6, 2.5, 0.0)
    heard = []

    class Event:
        progress = p

    live.ProgressListener(heard.append).onQueryProgress(Event())
    assert heard == [("q", 3, 5, 12, 6, 2.5, 0.0)]


def test_one_dead_query_ends_the_others(spark):
    w = workspace(spark, "watch")
    spark.range(3).write.parquet(f"{w}/in")
    s = spark.readStream.schema("id long").parquet(f"{w}/in")

    def fail(batch, batch_id):
        raise RuntimeError("no")

    good = live.append(s, f"{w}/out", f"{w}/cp1", {"processingTime": "1 hour"}, "good")
    bad = live.each_batch(s, fail, f"{w}/cp2", {"processingTime": "1 second"}, "bad")
    with pytest.raises(Exception, match="no"):
        live.watch([good, bad])
    assert not good.isActive
    again = live.append(s, f"{w}/out2", f"{w}/cp3", {"processingTime": "1 second"}, "again")
    live.drain(again)
    assert spark.read.parquet(f"{w}/out2").count() == 3


def test_jobs_refuse_what_breaks_their_rules(spark):

    w = workspace(spark, "jobs")
    rows = spark.createDataFrame([("A", datetime(2024, 1, 1), 1.0, 5)], "symbol string, window_start timestamp_ntz, close double, total_volume long")
    with pytest.raises(R.Refused):
        jobs.incremental_load(rows.drop("close"), f"{w}/t")
    assert jobs.incremental_load(rows, f"{w}/t") == 1 and jobs.offline_table(spark, f"{w}/t", rows).read().count() == 1
    previous = spark.createDataFrame([(f"S{i}",) for i in range(460)], "symbol string")
    candidate = previous.select("symbol", F.col("symbol").alias("company_name"), F.lit("x").alias("sector"))
    r = jobs.universe_refresh(previous, candidate, f"{w}/u", "run1", F.lit("2024-01-01").cast("timestamp")).first()
    assert (r.members, r.added, r.published) == (460, 0, True)
    assert U.governed(spark, f"{w}/u", F.lit("2024-01-01 05:00:00").cast("timestamp")).count() == 460
    with pytest.raises(ValueError, match="stale"):
        U.governed(spark, f"{w}/u", F.lit("2024-02-01").cast("timestamp"))
    few = spark.createDataFrame([(s, datetime(2024, 1, 1) + timedelta(minutes=30 * i), float(i)) for s in "AB" for i in range(40 if s == "A" else 5)], "symbol string, event_timestamp timestamp_ntz, close double")
    with pytest.raises(R.Refused):
        jobs.training_dataset(few, ["close"], 0.2, 8, 3)


def test_features_are_ranked_by_any_measure(spark):
    from tickspark.operators.drift import top_features

    d = spark.createDataFrame([("A", f, float(x), 1.0 - x) for f, x in (("a", 0.1), ("b", 0.5), ("c", 0.3), ("d", 0.4))], "symbol string, feature string, wasserstein double, psi double")
    assert [r.feature for r in top_features(d).orderBy("rank").collect()] == ["b", "d", "c"]
    assert [r.feature for r in top_features(d, "psi", 2).orderBy("rank").collect()] == ["a", "c"]


def test_loads_evolve_their_table_and_add_nothing_twice(spark):
    w = workspace(spark, "loaded")
    rows = spark.createDataFrame([("A", datetime(2024, 1, 1), 1.0, 5), ("A", datetime(2024, 1, 2), None, None), ("B", datetime(2024, 1, 1), None, 7)], "symbol string, window_start timestamp_ntz, close double, total_volume long")
    table = jobs.LoadedTable(spark, w)
    with pytest.raises(R.Refused):
        table.load(rows.drop("close"), "bad")
    one = table.load(rows, "one")
    assert (one.version, one.schema_version, one.inserted) == (1, 1, 3)
    # B's only close is null and nothing follows it: it stays null; A's second row is filled forward
    assert sorted((r.symbol, str(r.close), r.total_volume) for r in table.rows().read().collect()) == [("A", "1.0", 5), ("A", "1.0", 5), ("B", "None", 7)]
    more = rows.where("symbol = 'A'").withColumns({"window_start": F.col("window_start") + F.expr("interval 5 days"), "extra": F.lit("x"), "total_volume": F.col("total_volume").cast("int")})
    two = table.load(more.unionByName(rows.withColumn("extra", F.lit("x"))), "two")
    assert (two.schema_version, two.inserted) == (2, 2)
    assert table.load(more, "again").inserted == 0 and dict(table.rows().read().dtypes)["total_volume"] == "bigint"
    fewer = table.load(more.drop("extra").withColumn("window_start", F.col("window_start") + F.expr("interval 9 days")), "fewer")
    assert fewer.inserted == 2 and table.rows().read().where("extra is null").count() == 5
    assert {r.run_id: r.inserted for r in table.runs.latest("run_id").collect()} == {"one": 3, "two": 2, "again": 0, "fewer": 2}


def test_a_training_frame_needs_qualified_sessions_of_every_symbol(spark):
    rows = spark.createDataFrame([(s, datetime(2024, 1, 1 + i, 15), datetime(2024, 1, 1 + i, 15, 30), 1.0 + i, 10, "r1" if i < 4 else "r2") for s in "AB" for i in range(6 if s == "A" else 4)], "symbol string, window_start timestamp_ntz, event_timestamp timestamp_ntz, close double, total_volume long, dataset_version string")
    fit = '{"session_qualification": {"policy": "nyse-full-session-v1", "status": "passed"}}'
    book = spark.createDataFrame([("r1", "complete", fit), ("r2", "pending", fit)], "dataset_id string, status string, manifest string")
    none, now = rows.limit(0), F.lit("2024-02-01").cast("timestamp_ntz")
    made = jobs.training_frame(rows, none, book, ["A", "B"], now, least=4)
    assert {r.symbol: r.n for r in made.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {"A": 3, "B": 3}
    with pytest.raises(R.Refused, match="fewer than 5"):
        jobs.training_frame(rows, none, book, ["A", "B"], now, least=5)
    with pytest.raises(R.Refused, match="'C': 0"):
        jobs.training_frame(rows, none, book, ["A", "C"], now, least=4)
    with pytest.raises(R.Refused, match="no row"):
        jobs.training_frame(rows, none, book.where("status = 'pending'"), ["A"], now)


def test_a_forecast_takes_the_first_times_of_a_whole_decoder(spark):
    from tickspark.operators import calendar

    days = spark.createDataFrame([("2024-01-11", "2024-01-12")], "a string, b string").select(F.col("a").cast("date").alias("first_day"), F.col("b").cast("date").alias("last_day"))
    sess = calendar.held(calendar.sessions(days))
    history = spark.createDataFrame([("A", datetime(2024, 1, 11, 20, 30), 100.0), ("A", datetime(2024, 1, 11, 20), 90.0)], "symbol string, event_timestamp timestamp_ntz, close double")
    made = spark.createDataFrame([("A", h, q, 0.01) for h in range(1, 5) for q in (0.1, 0.5, 0.9)], "symbol string, horizon int, quantile double, y_pred double")
    offsets = spark.createDataFrame([(h, 50, q, q - 0.5) for h in range(1, 5) for q in (0.1, 0.5, 0.9)], "horizon int, paths long, quantile double, offset double")
    f = jobs.batch_forecast(made, offsets, history, sess, 2, decoder=4)
    steps = f.steps.orderBy("step").collect()
    # the last bar of the 11th, then the first of the 12th
    assert [r.event_timestamp for r in steps] == [datetime(2024, 1, 11, 21), datetime(2024, 1, 12, 15)] and [r.p50 for r in steps] == [101.005, 102.0201]
    assert f.summary.collect() == [("A", 2, 100.0, 2.0201, 0.0202)]
    for bad, message in (((made.where("horizon < 4"), offsets, history, sess), "whole"), ((made, offsets.where("horizon < 3"), history, sess), "calibrated"), ((made, offsets, history.limit(0), sess), "base price"), ((made, offsets, history, sess.where("session_date = '2024-01-11'")), "sessions end")):
        with pytest.raises(Exception, match=message):
            jobs.batch_forecast(*bad, 2, decoder=4).steps.collect()
    with pytest.raises(ValueError):
        jobs.batch_forecast(made, offsets, history, sess, 5, decoder=4)
