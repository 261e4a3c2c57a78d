"""Versioned tables in Parquet: immutable snapshot folders, and a pointer row for each version that is written last.

A version is a list of (partition, folder). An upsert rewrites the partitions that it touches into new folders and takes the
others over, so old versions stay readable until they are expired."""

from __future__ import annotations

import json
import tempfile
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickspark.operators.release import KEYS, upsert

POINTER = "version long, partition string, folder string, source string, batch long, created_at timestamp"

#: How the folders of appended rows begin.
ADDED = "added-"


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which all machines share; where that is unset, a temporary one on a single machine
    and an error on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix=f"{name}-")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def listed(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names in a folder (metadata only), none if it is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(n for x in fs.listStatus(p) if (n := x.getPath().getName()).endswith(suffix)) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def stream(spark: SparkSession, path: str, schema: StructType, files: int = 32, nested: bool = False) -> DataFrame:
    """``nested``: files lie in folders whose names are no columns, such as those of batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", nested).parquet(path)


def write_features(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False, partition_by: Sequence[str] = ()) -> None:
    """``single_file`` is for small exports only."""
    (df.coalesce(1) if single_file else df).write.mode(mode).partitionBy(*partition_by).parquet(path)


class VersionedTable:
    """``part``: an expression for a row's partition, such as the month of a bar's start.

    A change may name its ``source`` (a stream) and its batch: both are part of the pointer, so a batch that is delivered again
    is known before anything is written, and its data folder is its own, so one that died halfway is overwritten."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str = "date_format(window_start, 'yyyy-MM')", keys: Sequence[str] = KEYS):
        self.spark, self.path, self.schema, self.part, self.keys = spark, path, schema, part, tuple(keys)

    def create_if_missing(self) -> VersionedTable:
        if not exists(self.spark, f"{self.path}/pointers"):
            self._point(0, [])
        return self

    def _point(self, version: int, folders: list[tuple[str, str]], source: str | None = None, batch: int | None = None) -> None:
        rows = [(version, p, f, source, batch) for p, f in folders] or [(version, None, None, source, batch)]
        rows = self.spark.createDataFrame(rows, "version long, partition string, folder string, source string, batch long")
        path = f"{self.path}/pointers/v={version}"
        broken = exists(self.spark, path) and not exists(self.spark, f"{path}/_SUCCESS")  # a writer died in it
        rows.withColumn("created_at", F.current_timestamp()).coalesce(1).write.mode("overwrite" if broken else "errorifexists").parquet(path)

    def _pointers(self, versions: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/pointers/v={v}" for v in (self.versions() if versions is None else versions)]
        return self.spark.read.schema(POINTER).parquet(*paths)

    def versions(self) -> list[int]:
        """Those whose pointer was written to its end, which only the newest can lack."""
        found = sorted(int(n[2:]) for n in listed(self.spark, f"{self.path}/pointers") if n.startswith("v="))
        return found if not found or exists(self.spark, f"{self.path}/pointers/v={found[-1]}/_SUCCESS") else found[:-1]

    def version(self) -> int:
        return self.versions()[-1]

    def folders(self, version: int | None = None) -> dict[str, list[str]]:
        """The folders of each partition of the version: one, and those that were appended since it was rewritten (metadata)."""
        rows = self._pointers([self.version() if version is None else version]).where("folder is not null")
        found: dict[str, list[str]] = {}
        for r in rows.collect():
            found.setdefault(r.partition, []).append(r.folder)
        return {p: sorted(f) for p, f in found.items()}

    def applied(self, source: str, batch: int) -> int | None:
        """The version that this batch or a later one of the source made."""
        rows = self._pointers().where((F.col("source") == source) & (F.col("batch") >= batch))
        return rows.agg(F.min("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one by its number."""
        return self._rows([f for many in self.folders(version).values() for f in many])

    def added(self, version: int) -> DataFrame:
        """The rows of the folders that the version has and the one before it lacks: after an append, what it added."""
        before = {f for many in self.folders(version - 1).values() for f in many}
        return self._rows([f for many in self.folders(version).values() for f in many if f not in before])

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*sorted(folders)) if folders else self.spark.createDataFrame([], self.schema)

    def stream(self, files: int = 32) -> DataFrame:
        """The appended rows as a stream, each once, at most ``files`` files a trigger.

        Appends have folders of their own kind, which are all that the stream looks at, so it passes over what upserts and
        compactions rewrite. A stream that lags behind the retention of ``expire`` misses rows, as with any log."""
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).parquet(f"{self.path}/data/{ADDED}*")

    def _write(self, rows: DataFrame, version: int, kept: dict[str, list[str]], source: str | None = None, batch: int | None = None, own: bool = True, kind: str = "") -> int:
        """Data first, the pointer last; the partitions are those that the written folder holds."""
        name = kind + (f"{source}-{batch}" if own and source is not None else f"v={version}-{uuid.uuid4().hex}")
        folder, hidden = f"{self.path}/data/{name}", f"{self.path}/data/.{name}"
        if not exists(self.spark, folder):  # else a change that died before its pointer has written it to the end
            marked = rows.select(*[f.name for f in self.schema.fields], F.expr(self.part).alias("_part"))
            marked.write.mode("overwrite").partitionBy("_part").parquet(hidden)
            path = self.spark._jvm.org.apache.hadoop.fs.Path
            path(hidden).getFileSystem(self.spark._jsc.hadoopConfiguration()).rename(path(hidden), path(folder))
        new = {n.removeprefix("_part="): f"{folder}/{n}" for n in listed(self.spark, folder) if n.startswith("_part=")}
        pairs = [(p, f) for p, many in kept.items() for f in many] + list(new.items())
        self._point(version, sorted(pairs), source, batch)
        return version

    def append(self, rows: DataFrame, source: str | None = None, batch: int | None = None) -> int:
        """Adds the rows in folders of their own; nothing that is there is read or written."""
        if source is not None and (done := self.applied(source, batch)) is not None:
            return done
        now = self.version()
        return self._write(rows, now + 1, self.folders(now), source, batch, kind=ADDED)

    def upsert(self, rows: DataFrame, source: str | None = None, batch: int | None = None) -> int:
        """Updates rows with the same keys and inserts the others."""
        return self._write_touched(rows, lambda old, new: upsert(old, new, self.keys), source, batch)

    def _write_touched(self, rows: DataFrame, combine, source: str | None, batch: int | None) -> int:
        if source is not None and (done := self.applied(source, batch)) is not None:
            return done
        now = self.version()
        old = self.folders(now)
        rows = rows.persist()  # read for its partitions and again to be written
        try:
            touched = [r[0] for r in rows.select(F.expr(self.part)).distinct().collect()]
            current = self._rows([f for p in touched for f in old.get(p, [])])
            return self._write(combine(current, rows), now + 1, {p: f for p, f in old.items() if p not in touched}, source, batch)
        finally:
            rows.unpersist()

    def compact(self, files: int = 1, above: int | None = None) -> int:
        """The same rows in ``files`` files a partition, of the partitions with more than ``above`` files (``files`` if not given); the
        others stay where they are, and without any the version stays too."""
        now = self.version()
        old = self.folders(now)
        many = [p for p, folders in old.items() if sum(len(listed(self.spark, f, ".parquet")) for f in folders) > (files if above is None else above)]
        if not many:
            return now
        rows = self._rows([f for p in many for f in old[p]])
        dealt = rows.repartition(files * len(many), F.expr(self.part), *([F.pmod(F.xxhash64(*self.keys), F.lit(files))] if files > 1 else []))
        mark = self._pointers([now]).select("source", "batch").first()  # the last batch stays known
        return self._write(dealt, now + 1, {p: f for p, f in old.items() if p not in many}, mark.source, mark.batch, own=False)

    def expire(self, keep: int = 2, hours: float | None = None) -> list[str]:
        """Removes the data folders that only versions before the last ``keep`` use, and that no version that was the newest within
        the last ``hours`` uses if these are given; returns them. The pointers of versions that lost data go too."""
        newest = self.version()
        rows = self._pointers()
        made = {r.version: r.created_at for r in rows.groupBy("version").agg(F.min("created_at").alias("created_at")).collect()}
        ends = dict(zip(sorted(made), [made[v] for v in sorted(made)[1:]] + [None], strict=True))  # when the next one came
        since = None if hours is None else rows.select((F.current_timestamp() - F.expr(f"interval {int(hours * 3600)} seconds")).alias("t")).first().t
        live = {v for v in made if v > newest - keep or (since is not None and (ends[v] is None or ends[v] >= since))}
        used = rows.where("folder is not null").groupBy("folder").agg(F.max(F.col("version").isin(sorted(live))).alias("live"))
        gone = sorted(r.folder for r in used.where("not live").collect())
        names = {r.version for r in rows.where(F.col("folder").isin(gone)).select("version").distinct().collect()} if gone else set()
        for path in [f"{self.path}/pointers/v={v}" for v in sorted(names)] + gone:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        return gone


class Ledger:
    """Append-only rows in small files; the latest row of an id is its state."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def record(self, *row) -> None:
        self.spark.createDataFrame([row], self.schema).withColumn("recorded_ns", F.lit(time.time_ns())).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        schema = self.schema + ", recorded_ns long"
        return self.spark.read.schema(schema).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], schema)

    def latest(self, key: str) -> DataFrame:
        rows = self.rows()
        rest = [c for c in rows.columns if c != key]
        return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "recorded_ns").alias("_r")).select(key, "_r.*")


def schema_fingerprint(df: DataFrame) -> str:
    """A digest of the sorted column names and types."""
    import hashlib

    return hashlib.sha256("|".join(f"{n}:{t}" for n, t in sorted(df.dtypes)).encode()).hexdigest()


def evolve(target: DataFrame, updates: DataFrame) -> DataFrame:
    """The target with the columns that only the updates have, as nulls of their types."""
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in updates.schema.fields if f.name not in target.columns})


def merged_schema(old: StructType | None, new: StructType) -> StructType:
    """The old columns as they are, then the new ones; all may be null."""
    fields = list(old.fields) if old is not None else []
    held = {f.name for f in fields}
    return StructType([StructField(f.name, f.dataType, True) for f in [*fields, *[f for f in new.fields if f.name not in held]]])


class SchemaLedger:
    """The fingerprints of the rows that a table was given, and the columns that it has had by then; a new fingerprint is a new version."""

    def __init__(self, spark: SparkSession, path: str):
        self.ledger = Ledger(spark, path, "table string, version int, fingerprint string, fields string")

    def _last(self, table: str):
        return self.ledger.latest("table").where(F.col("table") == table).first()

    def record(self, table: str, df: DataFrame) -> int:
        """The version of the schema of ``df``, recorded if it changed."""
        last = self._last(table)
        fingerprint = schema_fingerprint(df)
        if last is not None and last.fingerprint == fingerprint:
            return last.version
        version = 1 if last is None else last.version + 1
        self.ledger.record(table, version, fingerprint, merged_schema(None if last is None else StructType.fromJson(json.loads(last.fields)), df.schema).json())
        return version

    def schema(self, table: str) -> StructType:
        """All columns that the table has had, each with its first type."""
        return StructType.fromJson(json.loads(self._last(table).fields))
