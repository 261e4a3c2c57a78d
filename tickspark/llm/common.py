"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyarrow import fs as pafs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it; everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def spread(df: DataFrame) -> DataFrame:
    """Dealt to all cores where the input has splits for less than half of them, such as one file with one row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset a folder of this machine, set once, or on a cluster an error."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickspark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; Spark's writers create it."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and survives a lost executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, df: DataFrame) -> str:
    """The name, or a longer one if ``df`` has such a column."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1000 rows and 32 MB where the session says nothing, since one text can have many MB."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))):
        if spark.conf.get(key, None) in (None, "10000", "-1"):
            spark.conf.set(key, value)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """For tasks that read or write parts of a file in the shared folder."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def ship(spark: SparkSession, path: str) -> str:
    """Sends a file to every worker; ``shipped`` finds it there by the name returned."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def shipped(name: str) -> str:
    return SparkFiles.get(name)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (int(seed) + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
