"""Katz backoff models of any order, as tables that are joined.

The n-grams of each order are a table of history, word and count, known by 64-bit hashes and partitioned by Spark. An n-gram
seen r times has ``d_r * r / c(h)`` with the Good-Turing discounts of its order; any other backs off to ``alpha(h)`` times the
probability after the history without its first word. As the shorter n-gram of one that was seen was seen too, the mass that
alpha shares is a sum over one join of neighbouring orders, and each history's probabilities add up to 1.

A token's score is found order by order: its longest n-gram that was seen, and on the way there the backoff weights of the
histories that were. Every token goes through two joins an order; ``katz.score`` has a form for order 2 that sends less.
Cases are those of ``katz``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut, mix64
from tickspark.llm.katz import CUT, END_HASH, discounts, held_out, text_hash, texts_of, tokens

START_HASH = -2


def histories(w: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """For each token the hash of the n - 1 words before it, for n from 2 on; ``first`` is where its text begins."""
    at, out = np.arange(len(w)), []
    total = np.zeros(len(w), np.uint64)
    for k in range(1, order):
        before = np.where(at - k >= first, w[np.maximum(at - k, 0)], START_HASH).view(np.uint64)
        with np.errstate(over="ignore"):
            total = total + mix64(before, k)
        out.append(mix64(total, 99).view(np.int64))
    return out


def token_rows(docs: DataFrame, order: int) -> DataFrame:
    """key (of the text), task, train, w and the histories h2 to h<order> of every token of every row, end tokens included."""
    names = ["key", "task", "row", "train", "w", *(f"h{m}" for m in range(2, order + 1))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            hashes, codes, lengths = tokens(b.column("text"))
            size = lengths + 1
            w = np.full(size.sum(), END_HASH, np.int64)
            last = np.cumsum(size) - 1
            inner = np.ones(len(w), bool)
            inner[last] = False
            w[inner] = hashes[codes] if len(hashes) else 0
            keys = text_hash(b.column("text"))
            new = np.array([not (k in seen or seen.add(k)) for k in keys.tolist()], bool)  # equal texts are scored once a task
            columns = [np.repeat(keys, size), np.full(len(w), TaskContext.get().partitionId(), np.int32), np.repeat(new, size), np.repeat(b.column("train").to_numpy(zero_copy_only=False), size), w]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in [*columns, *histories(w, np.repeat(last + 1 - size, size), order)]], names)

    schema = "key long, task int, row boolean, train boolean, w long" + "".join(f", h{m} long" for m in range(2, order + 1))
    return texts_of(docs, (~held_out(F.col("doc_id"))).alias("train")).mapInArrow(rows, schema)


def discounted(n: Column, d: np.ndarray) -> Column:
    return n * F.element_at(F.array(*(F.lit(float(x)) for x in np.append(d, 1.0))), F.least(n, F.lit(CUT + 1)).cast("int") + 1)


def fitted_discounts(counts: DataFrame) -> np.ndarray:
    return discounts({int(r.n): r["count"] for r in counts.where(F.col("n") <= CUT + 1).groupBy("n").count().collect()})


class Tables:
    """``words`` (w, n, p) with ``unknown``, and for each order from 2 the n-grams (h, w, p) and the histories (h, alpha)."""

    def __init__(self, training: DataFrame, order: int):
        self.order = order
        counts = cut(training.groupBy("w").agg(F.count("*").alias("n")), "katz-1")
        self.types, self.total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        d = fitted_discounts(counts)
        kept = counts.agg(F.coalesce(F.sum(discounted(F.col("n"), d)), F.lit(0.0))).first()[0]
        whole = self.total if kept < self.total - 1e-9 else self.total + 0.5
        self.unknown = 1 - kept / whole
        self.words = counts.withColumn("p", discounted(F.col("n"), d) / F.lit(float(whole)))
        self.grams: dict[int, DataFrame] = {}
        self.alphas: dict[int, DataFrame] = {}
        lower, on = self.words.select("w", F.col("p").alias("_p")), ["w"]
        for m in range(2, order + 1):
            h, rest = f"h{m}", [f"h{m - 1}"] if m > 2 else []
            counts = cut(training.groupBy(h, "w").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in rest)), f"katz-{m}")
            kept = discounted(F.col("n"), fitted_discounts(counts))
            sums = counts.join(lower, on).groupBy(h).agg(F.sum("n").alias("_n"), F.sum(kept).alias("_kept"), F.sum("_p").alias("_seen"))
            full = 1 - F.col("_seen") <= 1e-12  # every word was seen after it: nothing to back off to
            sums = sums.withColumn("_whole", F.when(full, F.col("_kept")).otherwise(F.when(F.col("_kept") < F.col("_n") - 1e-9, F.col("_n")).otherwise(F.col("_n") + 0.5)))
            sums = cut(sums.select(h, "_whole", F.when(full, 0.0).otherwise((1 - F.col("_kept") / F.col("_whole")) / (1 - F.col("_seen"))).alias("alpha")), f"katz-history-{m}")
            self.alphas[m] = sums.select(h, "alpha")
            self.grams[m] = cut(counts.join(sums, h).select(h, "w", (kept / F.col("_whole")).alias("p")), f"katz-grams-{m}")
            lower, on = self.grams[m].select(h, "w", F.col("p").alias("_p")), [h, "w"]

    def log10(self, rows: DataFrame) -> DataFrame:
        """``rows`` (w and histories) with n (training tokens of the word; 0) and log_p."""
        out = rows.join(self.words.select("w", "n", F.col("p").alias("_p1")), "w", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        log_p = F.log10(F.coalesce("_p1", F.lit(self.unknown)))
        for m in range(2, self.order + 1):
            h = f"h{m}"
            out = out.join(self.grams[m].withColumnRenamed("p", f"_p{m}"), [h, "w"], "left").join(self.alphas[m].withColumnRenamed("alpha", f"_a{m}"), h, "left")
            log_p = F.coalesce(F.log10(f"_p{m}"), F.log10(F.coalesce(f"_a{m}", F.lit(1.0))) + log_p)
        return out.withColumn("log_p", log_p)


def score(docs: DataFrame, order: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    if order < 1:
        raise ValueError("an n-gram has at least one word")
    bound_batches(docs.sparkSession)
    rows = cut(token_rows(docs, order), "katz-tokens")
    model = Tables(rows.where("train").select("w", *(f"h{m}" for m in range(2, order + 1))), order)
    less = F.log10(F.lit(float(model.total)) + 0.5 * (model.types + 1))
    each = model.log10(rows.where("row").drop("row", "train"))
    sums = each.groupBy("key", "task").agg(F.count("*").alias("n_tokens"), F.count_if(F.col("n") > 0).alias("n_known"), F.sum(F.log10(F.col("n") + 0.5) - less).alias("base_score"), F.sum("log_p").alias("score"))
    texts = cut(sums.groupBy("key").agg(F.min_by(F.struct("n_tokens", "n_known", "base_score", "score"), "task").alias("_s")), "katz-scores")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text_hash(b.column("text")))], ["doc_id", "key"])

    named = texts_of(docs, F.col("doc_id")).select("doc_id", "text").mapInArrow(keyed, "doc_id long, key long")
    names = ["n_tokens", "n_known", "base_score", "score"]
    return named.join(texts, "key").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *(F.col("_s")[c].alias(c) for c in names), F.lit(model.total).cast("long").alias("train_tokens"))
