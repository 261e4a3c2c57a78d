"""The live topology on Structured Streaming: decode, split, bars, upsert, and what is measured on the way."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tickspark.operators.bars import BAR_WIDTH, ohlcv
from tickspark.operators.quality import tag, trade_rules
from tickspark.sources.tables import VersionedTable, exists

WATERMARK = "2 minutes"


def bars_of(trades: DataFrame, watermark: str = WATERMARK, width: str = BAR_WIDTH) -> DataFrame:
    """Bars of a stream; event_time must be an instant, which a watermark needs."""
    return ohlcv(trades.withWatermark("event_time", watermark), width)


def append(df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str) -> StreamingQuery:
    return df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).queryName(name).trigger(**trigger).start()


def split_writer(bronze: str, dead: str, as_of: Column | None = None, handlers: list[Callable[[DataFrame, int], None]] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function: both tables from one tagged batch, so that they agree on each row.

    A stream that was tagged before it came here has the time of its batch, which a repeated batch keeps, so lateness is judged
    once for good. A batch has folders of its own; a folder that was written to its end is left as it is when the batch
    comes again, so a reader of the table sees its files once. Further ``handlers`` get the valid rows; one that fails fails
    the batch, and its offsets aren't committed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = (batch if "dq_reason" in batch.columns else tag(batch, trade_rules(as_of))).persist()
        spark = batch.sparkSession
        try:
            valid = tagged.where("dq_reason is null").drop("dq_reason")
            if not exists(spark, f"{bronze}/batch={batch_id}/_SUCCESS"):
                valid.write.mode("overwrite").parquet(f"{bronze}/batch={batch_id}")
            rejected = tagged.where("dq_reason is not null").withColumn("ingested_at", F.current_timestamp() if as_of is None else as_of)
            if not exists(spark, f"{dead}/batch={batch_id}/_SUCCESS") and not rejected.isEmpty():
                rejected.write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")
            for handle in handlers or []:
                handle(valid, batch_id)
        finally:
            tagged.unpersist()

    return write


#: Hours for which versions of a live table stay readable, and files a partition beyond which it is compacted.
RETENTION_HOURS, MOST_FILES = 168.0, 8


def upsert_writer(table: VersionedTable, compact_every: int = 0, source: str | None = None, hours: float = RETENTION_HOURS, most_files: int = MOST_FILES) -> Callable[[DataFrame, int], None]:
    """A batch function that merges bars into the table.

    With ``source``, the stream's name, the version's pointer holds the batch, and a batch that is delivered again changes
    nothing; without, keyed rows make it harmless. Every ``compact_every`` batches partitions of many files are compacted
    and versions that ended more than ``hours`` ago are expired."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]).persist()
        try:
            if rows.isEmpty():
                return
            table.upsert(rows, source, batch_id if source else None)
        finally:
            rows.unpersist()
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact(above=most_files)
            table.expire(hours=hours)

    return write


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict, name: str, mode: str = "append") -> StreamingQuery:
    return df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).queryName(name).trigger(**trigger).start()


def drain(*queries: StreamingQuery) -> None:
    """Processes what is there, stops, and raises what a query died of."""
    for q in queries:
        if q.isActive:
            q.processAllAvailable()
        q.stop()
        if q.exception():
            raise q.exception()


def watch(queries: list[StreamingQuery]) -> None:
    """Waits for all queries to end; if one dies the others are stopped and its error is raised."""
    left = list(queries)
    while left:
        q = left[0]
        q.awaitTermination(1)
        dead = [x for x in queries if not x.isActive and x.exception()]
        if dead:
            for x in queries:
                x.stop()
            raise dead[0].exception()
        left = [x for x in left if x.isActive]


def last_seen(trades: DataFrame) -> DataFrame:
    """Per symbol the last trade, as a running aggregate (complete or update mode)."""
    return trades.groupBy("symbol").agg(F.max("event_time").alias("last_trade"), F.count("*").alias("trades"))


def stale(seen: DataFrame, now: Column, seconds: int = 120) -> DataFrame:
    return seen.withColumn("stale", F.col("last_trade") < now - F.expr(f"interval {seconds} seconds"))


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """(name, batch, input rows, batch ms, lag): the lag is what the sources report as not yet read."""
    return [progress_row(p) for p in query.recentProgress]


def progress_row(p) -> tuple:
    lag = 0
    for s in p.sources if not isinstance(p, dict) else p["sources"]:
        m = s.metrics if not isinstance(s, dict) else s.get("metrics", {})
        lag += max(0, int(float((m or {}).get("maxOffsetsBehindLatest", 0))))
    take = (lambda k: p[k]) if isinstance(p, dict) else (lambda k: getattr(p, k))
    return take("name"), take("batchId"), take("numInputRows"), take("batchDuration") if not isinstance(p, dict) else p.get("durationMs", {}).get("triggerExecution", 0), lag


PROGRESS = "name string, batch long, input_rows long, batch_ms long, lag long, input_per_second double, processed_per_second double"


def partition_lag(source) -> int:
    """The sum over a source's partitions of what its latest offsets hold beyond the batch's end; 0 for sources without offsets
    by partition."""
    offsets = []
    for name in ("latestOffset", "endOffset"):
        value = source.get(name) if isinstance(source, dict) else getattr(source, name, None)
        try:
            value = json.loads(value) if isinstance(value, str) else value
        except ValueError:
            value = None
        offsets.append(value if isinstance(value, dict) else {})
    latest, end = offsets
    total = 0
    for topic, parts in latest.items():
        if isinstance(parts, dict):
            total += sum(max(0, int(n) - int((end.get(topic) or {}).get(p, 0))) for p, n in parts.items())
    return total


def progress_metrics(p) -> tuple:
    """One row of PROGRESS for a batch."""
    name, batch, rows, ms, reported = progress_row(p)
    take = p.get if isinstance(p, dict) else lambda k: getattr(p, k)
    lag = sum(partition_lag(s) for s in take("sources"))
    rate = [x if x is not None and math.isfinite(x) else 0.0 for x in (take("inputRowsPerSecond"), take("processedRowsPerSecond"))]
    return name, batch, rows, ms, max(lag, reported), *map(float, rate)


class ProgressListener(StreamingQueryListener):
    """Hands one row of PROGRESS a batch to ``sink``."""

    def __init__(self, sink: Callable[[tuple], None]):
        self.sink = sink

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.sink(progress_metrics(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


METRICS = "name string, batch long, input_rows long, batch_ms long, lag long, input_per_second double, processed_per_second double, observed map<string, long>"


class MetricsTable:
    """A row of METRICS a batch, in a file of its own, so that a batch that reports again replaces its row; no job is run for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, p) -> None:
        row = dict(zip(("name", "batch", "input_rows", "batch_ms", "lag", "input_per_second", "processed_per_second"), progress_metrics(p), strict=True))
        seen = (p.get("observedMetrics") if isinstance(p, dict) else p.observedMetrics) or {}
        row["observed"] = {k: v for r in seen.values() for k, v in (r if isinstance(r, dict) else r.asDict()).items() if v is not None}
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{row['name']}-{row['batch']}.json")
        out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, True)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def read(self) -> DataFrame:
        return self.spark.read.schema(METRICS).json(self.path)


class MetricsListener(StreamingQueryListener):
    """Adds a row to the table for each batch of the named queries."""

    def __init__(self, table: MetricsTable, names: set[str]):
        self.table, self.names = table, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name in self.names:
            self.table.add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
