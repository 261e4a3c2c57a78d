"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination, mixing.

Every stage gets what its predecessor kept and returns the columns of the documents; the last returns the mix: one row a
document with the words it gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from tickspark.llm.common import WORD, scratch, table
from tickspark.llm.queries import quality_weights


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no word is left go, as all they had stays in others; those that had none before stay."""
    out = line_dedup.dedup(docs)
    out = out.where((F.col("n_deleted") == 0) | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, quality_weights(spark, sf_dir))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]
#: The toxicity scores and the near-duplicate signatures have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written as Parquet and read again as the next stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
