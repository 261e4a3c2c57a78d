"""Training frames: history checks, the temporal split, decoder windows and leakage guards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.functions.columns import log_columns, time_columns
from tickspark.operators.bars import log_return_target, time_index
from tickspark.operators.calendar import holiday_flags, new_york_date


def min_history(rows: DataFrame, least: int = 60, time: str = "event_timestamp") -> DataFrame:
    """Per symbol: distinct New York dates, and whether these are enough."""
    return rows.groupBy("symbol").agg(F.count_distinct(new_york_date(time)).alias("sessions")).withColumn("enough", F.col("sessions") >= least)


def model_frame(rows: DataFrame, time: str = "event_timestamp", training: bool = True) -> DataFrame:
    """Index, calendar flags, time columns, logs and the target."""
    out = holiday_flags(time_index(rows, time), time)
    return log_return_target(out.withColumns(time_columns(time) | log_columns()), time, training)


def prediction_frame(history: DataFrame, future: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """The history, followed by each symbol's last row carried to its future times (symbol, ``time``), with a target of 0."""
    carried = [c for c in history.columns if c not in ("symbol", time)]
    last = history.groupBy("symbol").agg(F.max_by(F.struct(*carried), time).alias("_v"))
    ahead = future.select("symbol", time).join(F.broadcast(last), "symbol").select("symbol", time, "_v.*")
    both = history.unionByName(ahead)
    return model_frame(both, time, training=False)


def cutoff(rows: DataFrame, ratio: float = 0.2, time: str = "event_timestamp") -> DataFrame:
    """One row: the distinct time with number floor(n (1 - ratio)), n of which there are; the bars' times are few.

    A ratio that leaves no training or no holdout times is an error where the cutoff is used."""
    if not 0 < ratio < 1:
        raise ValueError("the ratio leaves no training or no holdout times")
    times = rows.agg(F.array_sort(F.collect_set(time)).alias("_t"))
    n = F.size("_t")
    k = F.floor(n * F.lit(1 - ratio)).cast("int")
    fits = (k > 0) & (k < n)
    return times.select(F.when(fits, F.get("_t", F.greatest(k, F.lit(1)) - 1)).otherwise(F.raise_error(F.lit("the ratio leaves no training or no holdout times"))).alias("cutoff"))


def temporal_split(rows: DataFrame, ratio: float = 0.2, encoder: int = 780, horizon: int = 39, time: str = "event_timestamp") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, validation rows (encoder context and holdout), and boundaries of each symbol with their sufficiency."""
    at = F.broadcast(cutoff(rows, ratio, time))
    marked = time_index(rows, time).crossJoin(at)
    train = marked.where(F.col(time) <= F.col("cutoff")).drop("cutoff")
    holdout = marked.where(F.col(time) > F.col("cutoff")).drop("cutoff")
    recent = W.partitionBy("symbol").orderBy(F.desc(time))
    context = train.withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= encoder).drop("_r")
    counts = train.groupBy("symbol").agg(F.count("*").alias("train_rows"), F.max("time_idx").alias("training_last_idx"))
    boundaries = counts.join(holdout.groupBy("symbol").agg(F.count("*").alias("holdout_rows")), "symbol", "left").fillna(0, ["holdout_rows"])
    enough = (F.col("train_rows") >= encoder) & (F.col("holdout_rows") >= horizon)
    return train, context.unionByName(holdout), boundaries.withColumn("sufficient", enough)


def decoder_index(rows: DataFrame, boundaries: DataFrame, encoder: int, horizon: int) -> DataFrame:
    """Origins whose encoder and decoder windows lie in the rows; in_holdout: all decoder steps are after the training rows.

    Half of the encoder and one decoder step are enough."""
    span = rows.groupBy("symbol").agg(F.min("time_idx").alias("_a"), F.max("time_idx").alias("_b"))
    each = rows.select("symbol", "time_idx").join(F.broadcast(span), "symbol").where(F.col("time_idx") - F.col("_a") >= encoder // 2)
    index = each.select("symbol", F.col("time_idx").alias("time_idx_first_prediction"), F.least(F.col("time_idx") + horizon - 1, F.col("_b")).alias("time_idx_last"))
    unique = F.broadcast(boundaries.groupBy("symbol").agg(F.max("training_last_idx").alias("training_last_idx"), F.count("*").alias("_n")).where("_n = 1"))
    return index.join(unique, "symbol", "left").withColumn("in_holdout", F.coalesce(F.col("time_idx_first_prediction") > F.col("training_last_idx"), F.lit(False))).select("symbol", "time_idx_first_prediction", "time_idx_last", "in_holdout")


def leaks(index: DataFrame, rows: DataFrame, cut: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Decoder steps that were not observed, or not after the cutoff."""
    steps = index.select("symbol", F.explode(F.sequence("time_idx_first_prediction", "time_idx_last")).alias("time_idx"))
    seen = steps.distinct().join(rows.select("symbol", "time_idx", time), ["symbol", "time_idx"], "left").crossJoin(F.broadcast(cut))
    return seen.where(F.col(time).isNull() | (F.col(time) <= F.col("cutoff"))).select("symbol", "time_idx", time)


def purged_windows(index: DataFrame, count: int = 3, horizon: int = 39, order: str = "time_idx_first_prediction") -> DataFrame:
    """``index`` in ``count`` successive evaluation windows; the last ``horizon`` origins of all but the last one go."""
    origins = index.select(order).distinct()
    w = origins.withColumn("window", F.ntile(count).over(W.orderBy(order)))  # one row a distinct origin
    r = F.row_number().over(W.partitionBy("window").orderBy(F.desc(order)))
    kept = w.withColumn("_r", r).where((F.col("window") == count) | (F.col("_r") > horizon)).drop("_r")
    return index.join(F.broadcast(kept), order)


def sequence_examples(rows: DataFrame, columns: Sequence[str], encoder: int, horizon: int, stride: int = 1) -> DataFrame:
    """Encoder and decoder arrays of every origin with at least half of an encoder and one decoder step."""
    w = W.partitionBy("symbol").orderBy("time_idx")
    value = F.struct("time_idx", *columns)
    ex = rows.select("symbol", "time_idx", F.collect_list(value).over(w.rowsBetween(-encoder, -1)).alias("encoder"), F.collect_list(value).over(w.rowsBetween(0, horizon - 1)).alias("decoder"))
    return ex.where((F.size("encoder") >= encoder // 2) & (F.size("decoder") >= 1) & (F.col("time_idx") % stride == 0))


#: Bytes of the arrays that one task makes at a time, about.
PACKED = 64 << 20


def packed_examples(rows: DataFrame, columns: Sequence[str], encoder: int, horizon: int, index: DataFrame | None = None, block: int | None = None) -> DataFrame:
    """symbol, time_idx, and for each column the arrays ``<column>_encoder`` and ``<column>_decoder``: the examples of
    ``sequence_examples`` as packed numbers.

    Rows go to blocks of ``block`` successive places of a symbol, and to the next ones whose encoders, and the last one whose
    decoders, reach into them; the arrays are cut inside the task. So what is shuffled is about 1 + (encoder + horizon) /
    block rows a row, and not encoder rows a row. ``time_idx`` counts a symbol's rows without gaps, as ``time_index`` does.
    With ``index`` (symbol, time_idx_first_prediction) only its origins are made. Nulls become NaN."""
    names = list(columns)
    size = block or max(encoder + horizon, PACKED // (8 * len(names) * (encoder + horizon)))
    marked = rows.select("symbol", "time_idx", *[F.col(c).cast("double").alias(c) for c in names])
    if index is None:
        marked = marked.withColumn("_origin", F.lit(True))
    else:
        wanted = index.select("symbol", F.col("time_idx_first_prediction").alias("time_idx")).distinct().withColumn("_o", F.lit(True))
        marked = marked.join(wanted, ["symbol", "time_idx"], "left").withColumn("_origin", F.col("_o").isNotNull()).drop("_o")
    first, last = F.floor(F.greatest(F.col("time_idx") - (horizon - 1), F.lit(0)) / size), F.floor((F.col("time_idx") + encoder) / size)
    dealt = marked.withColumn("_block", F.explode(F.sequence(first, last)))

    def cut(group: pa.Table) -> pa.Table:
        group = group.sort_by("time_idx")
        at, origin = group["time_idx"].to_numpy(), group["_origin"].to_numpy(zero_copy_only=False)
        number = group["_block"][0].as_py()
        here = np.flatnonzero((at // size == number) & origin)
        lo, hi = np.maximum(here - encoder, 0), np.minimum(here + horizon, len(at))
        fits = here - lo >= encoder // 2
        here, lo, hi = here[fits], lo[fits], hi[fits]

        def slices(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.ListArray:
            lengths = stop - start
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            places = np.repeat(start - offsets[:-1], lengths) + np.arange(offsets[-1])
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[places]))

        out = {"symbol": group["symbol"].combine_chunks().take(pa.array(here)), "time_idx": pa.array(at[here], pa.int64())}
        for c in names:
            values = group[c].to_numpy().astype(float)
            out |= {f"{c}_encoder": slices(values, lo, here), f"{c}_decoder": slices(values, here, hi)}
        return pa.table(out)

    schema = "symbol string, time_idx long, " + ", ".join(f"`{c}_encoder` array<double>, `{c}_decoder` array<double>" for c in names)
    return dealt.groupBy("symbol", "_block").applyInArrow(cut, schema)


def groups_without_windows(rows: DataFrame, index: DataFrame, group: str = "symbol") -> DataFrame:
    """Groups of the rows that no decoder window belongs to."""
    return rows.select(group).distinct().join(index.select(group).distinct(), group, "left_anti")
