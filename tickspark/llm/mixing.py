"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every source has a word target. Whole epochs come first: each document of the source is taken as often as the source fits
into the target. What is left of the target is filled in the order of exponential keys ``-ln(u) / weight``, smallest first;
the document on which the budget runs out gives its remaining words only.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a source of its own and ranks last; rows that
repeat are documents of their own; a document's uniform number depends on its id and the seed, so reruns agree; equal keys
are ordered by id and size; a source without words has the target 0; an empty table gives an empty result. Other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.llm.common import cut, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Key ranges a source is cut into, so that no task sorts a whole source; one range in 4096 of a source with 10^10 documents is 2.4 million short rows.
RANGES = 4096


def uniform(doc_id: Column, seed: int) -> Column:
    """In (0, 1), from 52 bits of an MD5, which other engines compute alike."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, source_size): the target of each source, at most ``most`` times its size, the excess reshared by weight.

    The shares are a level ``t`` with ``sum(min(cap, t * weight)) = budget``: in the order of cap / weight, sources are full
    as long as the level that the others would get is at least their own. One row a source goes through one window."""
    by_name = W.orderBy(F.col("source").isNull(), "source")
    by_level = W.orderBy("_level", "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    s = (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_level", F.col("_cap") / F.col("_weight"))
    )
    ahead, behind = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (
        s.withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(ahead), F.lit(0.0)))
        .withColumn("_t", F.col("_left") / F.sum("_weight").over(behind))
        .withColumn("_open", F.col("_t") < F.col("_level"))
        .withColumn("_at", F.min(F.when(F.col("_open"), F.struct("_level", "_rank", "_t"))).over(every))
    )
    full = F.col("_at").isNull() | ~F.col("_open") & (F.struct("_level", "_rank") < F.struct(F.col("_at._level"), F.col("_at._rank")))
    return s.select("source", "source_size", F.when(full, F.col("_cap")).otherwise(F.col("_at._t") * F.col("_weight")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, seed: int = 8, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs of every row of ``docs`` (doc_id, text, source).

    ``quality``: (doc_id, weight), weights positive, the largest of an id's counts; 1 for documents without one."""
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    if quality is not None:
        sized = sized.join(quality.groupBy("doc_id").agg(F.max("weight").alias("_quality")), "doc_id", "left")
    else:
        sized = sized.withColumn("_quality", F.lit(1.0))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("_quality", F.lit(1.0))
    sized = cut(sized.select("doc_id", "source", "size", key.alias("_key")), "mix-keys")
    # 1 - exp(-key / mean) runs through (0, 1) in the order of the keys, evenly whatever the weights' scale is
    mean = sized.agg(F.coalesce(F.avg("_key"), F.lit(1.0))).first()[0]
    sized = sized.withColumn("_range", F.least(F.lit(RANGES - 1), F.floor((1 - F.exp(-F.col("_key") / F.lit(mean))) * RANGES)).cast("int"))
    in_range = sized.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    source = targets(in_range.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    plan = source.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")).withColumn(
        "_rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    before = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = in_range.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))).alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select("r.source", "_range", "_words", "_before", "source_size", "target", "epochs", "_rest")
    ranges = cut(ranges, "mix-ranges")  # at most RANGES short rows a source
    d = sized.alias("d").join(ranges.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d._range") == F.col("r._range")))
    d = d.select("doc_id", "d.source", "size", "_key", "d._range", "_words", "_before", "source_size", "target", "epochs", "_rest")
    whole = F.col("_before") + F.col("_words") <= F.col("_rest")
    none = F.col("_before") >= F.col("_rest")
    clear = d.where(whole | none).withColumn("taken", F.col("epochs") * F.col("size") + F.when(whole, F.col("size")).otherwise(0))
    # the one range of each source in which the budget runs out
    ahead = W.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = d.where(~(whole | none)).withColumn("_room", F.col("_rest") - F.col("_before") - F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    edge = edge.withColumn("taken", F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_room"))))
    out = ["doc_id", "source", "size", "source_size", "target", "taken", "epochs"]
    return clear.select(out).unionByName(edge.select(out))
