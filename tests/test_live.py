"""The live job under crashes: batches that come again, metrics, retention, lateness at the limit, drained sessions."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import bars as B
from tickspark.operators import calendar as C
from tickspark.schemas import BAR
from tickspark.sources import releases as R
from tickspark.sources.tables import VersionedTable, listed, workspace
from tickspark.streaming import live

ONCE = {"availableNow": True}
TRADE = "symbol string, price double, volume double, timestamp long, event_time timestamp"
START = datetime(2024, 1, 2, 14, 30)


def trades(spark, times, symbol="A", price=1.0):
    rows = [(symbol, price + i, 1.0, int(t.timestamp() * 1000), t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, TRADE)


def source(spark, w, files=None):
    s = spark.readStream.schema(TRADE).option("recursiveFileLookup", "true")
    return (s.option("maxFilesPerTrigger", files) if files else s).parquet(f"{w}/in")


def state(table):
    """Versions, rows and data folders; folder names without their random part."""
    folders = {v: sorted(f.rsplit("/data/", 1)[1] for many in table.folders(v).values() for f in many) for v in table.versions()}
    return folders, sorted(map(tuple, table.read().collect()), key=str), listed(table.spark, f"{table.path}/data")


def feed(spark, w):
    for i in range(3):
        trades(spark, [START + timedelta(minutes=20 * i + m) for m in range(20)]).coalesce(1).write.parquet(f"{w}/in/{i}")


def run_gold(spark, w, table, write):
    return live.each_batch(live.bars_of(source(spark, w, 1)), write, f"{w}/cp", ONCE, "gold", "update")


@pytest.mark.parametrize("dies", ["before the pointer", "after the pointer"])
def test_an_upsert_that_dies_is_repeated_as_if_it_had_not(spark, dies):
    clean, w = workspace(spark, "clean"), workspace(spark, "dies")
    for path in (clean, w):
        feed(spark, path)
    want = VersionedTable(spark, f"{clean}/gold", BAR).create_if_missing()
    run_gold(spark, clean, want, live.upsert_writer(want, source="gold")).awaitTermination()
    table = VersionedTable(spark, f"{w}/gold", BAR).create_if_missing()
    write, once = live.upsert_writer(table, source="gold"), {"left": 1}
    point = table._point

    def broken_point(*args):
        if args[0] == 2 and once["left"] and dies == "before the pointer":
            once["left"] = 0
            raise RuntimeError("died")
        point(*args)

    def broken_write(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and once["left"] and dies == "after the pointer":
            once["left"] = 0
            raise RuntimeError("died")

    table._point = broken_point
    with pytest.raises(Exception, match="died"):
        run_gold(spark, w, table, broken_write).awaitTermination()
    run_gold(spark, w, table, broken_write).awaitTermination()
    assert state(table) == state(want) and want.version() == 3


def test_an_older_batch_of_a_stream_changes_nothing(spark):
    t = VersionedTable(spark, workspace(spark, "old"), BAR).create_if_missing()
    b = B.ohlcv(trades(spark, [START])).select([F.col(f.name).cast(f.dataType) for f in BAR.fields])
    assert [t.upsert(b, "s", 4), t.upsert(b.withColumn("close", F.lit(9.0)), "s", 4), t.upsert(b, "s", 3), t.upsert(b, "other", 0)] == [1, 1, 1, 2]
    t.compact(above=0)
    assert t.version() == 3 and t.applied("other", 0) == 2 and t.read().first().close == 1.0


def test_a_reader_of_a_pinned_version_survives_many_batches(spark):
    t = VersionedTable(spark, workspace(spark, "pinned"), BAR).create_if_missing()
    write = live.upsert_writer(t, compact_every=2, source="gold", most_files=0)
    months = [datetime(2024, m, 2) for m in (1, 2)]
    for i in range(9):
        b = B.ohlcv(trades(spark, [months[i % 2]], price=float(i)))
        write(b, i)
        if i == 3:
            pinned, rows = t.version(), sorted(map(tuple, t.read().collect()))
    assert sorted(map(tuple, t.read(pinned).collect())) == rows and t.version() > pinned + 4


def test_compaction_leaves_partitions_of_few_files(spark):
    t = VersionedTable(spark, workspace(spark, "few"), BAR).create_if_missing()
    t.append(B.ohlcv(trades(spark, [datetime(2024, 1, 2)])).coalesce(1).select([F.col(f.name).cast(f.dataType) for f in BAR.fields]))
    many = B.ohlcv(trades(spark, [datetime(2024, 2, 2) + timedelta(hours=i) for i in range(30)]))
    t.append(many.repartition(5).select([F.col(f.name).cast(f.dataType) for f in BAR.fields]))
    before = t.folders()
    t.compact(above=2)
    after = t.folders()
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"] and t.read().count() == 31
    version = t.version()
    assert t.compact(above=2) == version


def bar_rows(spark, times, price=1.0):
    return B.ohlcv(trades(spark, times, price=price)).select([F.col(f.name).cast(f.dataType) for f in BAR.fields])


def test_appended_rows_are_streamed_once(spark):
    w = workspace(spark, "versions")
    t = VersionedTable(spark, f"{w}/t", BAR).create_if_missing()
    day = datetime(2024, 1, 2)

    def read():
        live.append(t.stream(2), f"{w}/out", f"{w}/cp", ONCE, "versions").awaitTermination()  # a restart each time
        return sorted(r.window_start for r in spark.read.schema(BAR).parquet(f"{w}/out").collect())

    times = [day + timedelta(hours=h) for h in range(12)]
    t.append(bar_rows(spark, times[:4]).repartition(3))
    assert read() == times[:4]
    t.append(bar_rows(spark, times[4:6]), "s", 0)
    t.compact(files=1, above=0)
    t.upsert(bar_rows(spark, times[:2], price=9.0))
    t.append(bar_rows(spark, times[4:6]), "s", 0)  # comes again
    t.append(bar_rows(spark, times[6:]).repartition(5))
    assert read() == times and read() == times
    assert t.read().count() == 12 and {r.close for r in t.read().where(F.col("window_start").isin(times[:2])).collect()} == {9.0, 10.0}


def test_an_append_that_dies_before_its_pointer_is_taken_up(spark):
    w = workspace(spark, "died")
    t = VersionedTable(spark, f"{w}/t", BAR).create_if_missing()
    rows, point = bar_rows(spark, [datetime(2024, 1, 2)]), t._point

    def die(*args):
        raise RuntimeError("died")

    t._point = die
    with pytest.raises(RuntimeError):
        t.append(rows, "s", 0)
    t._point = point
    assert t.read().isEmpty() and t.append(rows, "s", 0) == 1 and t.read().count() == 1
    live.append(t.stream(), f"{w}/out", f"{w}/cp", ONCE, "died").awaitTermination()
    assert spark.read.schema(BAR).parquet(f"{w}/out").count() == 1


def test_every_trade_is_on_one_side_whenever_the_queries_look(spark):
    """Rows around the limit of lateness, and a batch that dies between its two tables and comes again later."""
    w = workspace(spark, "late")
    now = datetime.now()
    trades(spark, [now - timedelta(seconds=x) for x in range(290, 311)]).write.parquet(f"{w}/in/0")
    failing = {"left": 1}

    def once(batch, batch_id):
        if failing["left"]:
            failing["left"] = 0
            raise RuntimeError("died")

    from tickspark.operators import quality

    def run(handlers):
        tagged = quality.tag(source(spark, w), quality.trade_rules())
        return live.each_batch(tagged, live.split_writer(f"{w}/bronze", f"{w}/dead", None, handlers), f"{w}/cp", ONCE, "trades")

    with pytest.raises(Exception, match="died"):
        run([once]).awaitTermination()
    import time

    time.sleep(3)  # on a clock of its own the second attempt would reject other rows
    run([once]).awaitTermination()
    sides = [spark.read.parquet(f"{w}/{x}").select("timestamp") for x in ("bronze", "dead")]
    both = sides[0].unionByName(sides[1])
    assert both.count() == both.distinct().count() == 21 and all(not s.isEmpty() for s in sides)


def test_metrics_are_kept_by_batch_and_reason(spark):
    w = workspace(spark, "metrics")
    good = trades(spark, [START + timedelta(minutes=m) for m in range(4)])
    good.write.parquet(f"{w}/in/0")
    bad = good.limit(3).withColumns({"symbol": F.lit(" "), "price": F.when(F.col("price") > 1, F.lit(-1.0)).otherwise(F.col("price"))})
    bad.write.parquet(f"{w}/in/1")
    job = jobs.live_session(source(spark, w), w, F.lit("2024-01-02 14:31:00").cast("timestamp") + F.expr("interval 5 minutes"), ONCE)
    live.watch(job.queries)
    job.close()
    seen = {}
    for r in job.metrics.read().where("name = 'trades'").collect():
        for k, v in r.observed.items():
            seen[k] = seen.get(k, 0) + v
    assert (seen["rows"], seen["missing_symbol"], seen["invalid_price"]) == (7, 3, 2)
    assert seen["rejected"] == spark.read.parquet(job.dead).count() and seen["rows"] - seen["rejected"] == spark.read.parquet(job.bronze).count()
    before = job.metrics.read().count()
    job.metrics.add({"name": "trades", "batchId": 0, "numInputRows": 1, "sources": [], "durationMs": {}, "inputRowsPerSecond": 1.0, "processedRowsPerSecond": 1.0})
    assert job.metrics.read().count() == before  # a batch that reports again replaces its row


def test_a_drained_session_becomes_a_release(spark):
    w = workspace(spark, "finish")
    day = C.sessions(spark.createDataFrame([(date(2026, 9, 28), date(2026, 9, 28))], "first_day date, last_day date"))
    times = [datetime(2026, 9, 28, 13, 30) + timedelta(minutes=i) for i in range(390)]
    trades(spark, times).unionByName(trades(spark, times, "B")).write.parquet(f"{w}/in/0")
    job = jobs.live_session(source(spark, w), f"{w}/live", F.lit("2026-09-28").cast("timestamp"), {"processingTime": "1 second"})
    release = jobs.finish_session(job, B.ohlcv(trades(spark, [])), day, ["A", "B"], f"{w}/releases", "r1")
    assert spark.read.json(f"{release}/manifest").first().symbols == ["A", "B"]
    assert spark.read.parquet(f"{release}/bars").count() == 26 and not any(q.isActive for q in job.queries)
    with pytest.raises(R.Refused):
        R.complete_session(spark.read.parquet(job.bronze).where("symbol = 'A'"), B.ohlcv(trades(spark, [])), day, ["A", "B"], f"{w}/releases", "r2")
