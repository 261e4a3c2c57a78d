"""Token counts as rollups that are maintained by deltas.

A batch of changes inserts, revises or deletes the counts of documents. From the state of the changed documents alone the
batch's signed deltas follow (what a document counts now less what it counted before), summed by source, language and
tokenizer version; totals are the sum of the deltas of all committed batches, so nothing is ever counted anew.

A batch writes its state and its deltas under its own number and its commit mark last. A batch that was broken off has no
mark; running it again overwrites what it left. A batch with a mark is not applied again.

Defined cases: an insert of a known document revises it, a revision of an unknown one inserts it, a delete of an unknown one
changes nothing; of several changes to one document in a batch the one with the highest ``seq`` holds; null texts count 0;
null sources and languages are groups of their own; null counts are 0; batches must come in the order of their numbers. A
document is a doc_id and, where changes have such a column, its ``copy``: rows that share an id, or have none, count as one
document unless their copies differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import byte_bpe
from tickspark.llm.common import cut, word_count

GROUP = ["source", "lang", "tokenizer"]
STATE = "doc_id long, source string, lang string, tokenizer string, n_tokens long, copy long, batch long, bucket int"
#: The state is dealt to so many folders by document, and a batch reads those it touches.
BUCKETS = 64
DELTA = "source string, lang string, tokenizer string, docs long, tokens long, batch long"


def count_tokens(docs: DataFrame, vocabulary: str, version: str) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens: of every document, its words and its tokens by the ranks in the file.

    Texts of any length are counted, whatever runs of blanks, letters or marks they hold (see ``byte_bpe``)."""
    coded = byte_bpe.encode(docs.select("doc_id", "source", "lang", "text"), vocabulary)
    counted = coded.select("doc_id", "source", "lang", word_count(F.col("text")).alias("words"), byte_bpe.n_tokens(F.col("ids")).alias("pieces"))
    both = F.array(F.struct(F.lit("words-1").alias("tokenizer"), F.col("words").alias("n_tokens")), F.struct(F.lit(version).alias("tokenizer"), F.col("pieces").alias("n_tokens")))
    return counted.select("doc_id", "source", "lang", F.inline(both))


class TokenRollup:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, kind: str, schema: str, batches: list[int]) -> DataFrame:
        paths = [f"{self.folder}/{kind}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{kind}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def committed(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return []
        return sorted(r.batch for r in self.spark.read.schema("changes long, batch long").parquet(f"{self.folder}/commits").select("batch").collect())

    def state(self, buckets: list[int] | None = None) -> DataFrame:
        """The latest row of every document and tokenizer (of some buckets); n_tokens is null after a delete."""
        rows = self._read("state", STATE, self.committed())
        rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
        latest = rows.groupBy("doc_id", F.coalesce("copy", F.lit(0)).alias("copy"), "tokenizer").agg(F.max_by(F.struct("source", "lang", "n_tokens"), "batch").alias("_s"))
        return latest.select("doc_id", "copy", "tokenizer", "_s.*")

    def totals(self) -> DataFrame:
        rows = self._read("deltas", DELTA, self.committed())
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Applies ``changes`` (op: insert, revise or delete; doc_id, source, lang, tokenizer, n_tokens, optionally seq and copy).

        False if the batch was committed before."""
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after {done[-1]}")
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        copy = (F.coalesce("copy", F.lit(0)) if "copy" in changes.columns else F.lit(0)).cast("long").alias("copy")
        n = F.when(F.col("op") != "delete", F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long"))
        order = F.struct(seq.alias("seq"), "op", n.alias("n"), F.col("source").alias("s"), F.col("lang").alias("l"))
        new = changes.where("op in ('insert', 'revise', 'delete')").groupBy("doc_id", copy, "tokenizer").agg(F.max(order).alias("_n"))
        new = new.select("doc_id", "copy", "tokenizer", F.col("_n.s").alias("source"), F.col("_n.l").alias("lang"), F.col("_n.n").alias("n_tokens"))
        new = new.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(BUCKETS)).cast("int"))
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/state/batch={batch}")
        new = self.spark.read.schema("doc_id long, copy long, tokenizer string, source string, lang string, n_tokens long, bucket int").parquet(f"{self.folder}/state/batch={batch}")
        signed = [new.where("n_tokens is not null").select(*GROUP, F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens"))]
        if done:
            touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most BUCKETS
            old, key = self.state(touched).alias("o"), new.select("doc_id", "copy", "tokenizer").alias("k")
            met = old.join(key, F.col("o.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("o.copy") == F.col("k.copy")) & F.col("o.tokenizer").eqNullSafe(F.col("k.tokenizer")), "left_semi")
            signed.append(met.where("n_tokens is not null").select(*GROUP, F.lit(-1).alias("docs"), (-F.col("n_tokens")).alias("tokens")))
        rows = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
        rows.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens")).write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")
        new.agg(F.count("*").alias("changes")).write.mode("overwrite").parquet(f"{self.folder}/commits/batch={batch}")
        return True
