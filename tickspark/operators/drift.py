"""Drift between a reference and a current sample, for any number of groups at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.sources.tables import workspace

BINS, FLOOR, DIGITS = 10, 1e-6, 6
MIN_REFERENCE, MIN_CURRENT = 50, 20


def both(reference: DataFrame, current: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """The finite values of both samples, _side 0 and 1."""

    def part(df: DataFrame, side: int) -> DataFrame:
        v = F.col(value).cast("double")
        return df.select(*by, F.round(v, DIGITS).alias("value"), F.lit(side).alias("_side")).where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    return part(reference, 0).unionByName(part(current, 1))


def ranged(samples: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """(by, value, _a, _b, _p): how often each side has each value, once, in ranges of (by, value) that hold about as many values each.

    The ranges are drawn by sampling, so they are written: whatever is derived from them must see the same ones."""
    spark = samples.sparkSession
    counted = samples.groupBy(*by, "value").agg(F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.repartitionByRange(parts, *by, "value").withColumn("_p", F.spark_partition_id())
    path = workspace(spark, "drift")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def met(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, nulls of keys compared as values."""
    same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], F.lit(True))
    return left.alias("l").join(right.alias("r"), same).select("l.*", *[f"r.{c}" for c in right.columns if c not in keys])


def cumulated(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """``ranged`` rows with _before_a, _before_b (what lies before the value), _next (the value after it), _n0 and _n1, by a parallel
    prefix sum: each range sums its own values, and one row a range carries what lies before it and the value after it.

    So one group with all values is spread over all ranges."""
    edges = values.groupBy(*by, "_p").agg(F.sum("_a").alias("_ta"), F.sum("_b").alias("_tb"), F.min("value").alias("_first"))
    w = W.partitionBy(*by).orderBy("_p")  # a row a range
    before, whole = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = edges.select(*by, "_p", *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(o) for t, o in (("_ta", "_oa"), ("_tb", "_ob"))], F.lead("_first").over(w).alias("_after"), F.sum("_ta").over(whole).alias("_n0"), F.sum("_tb").over(whole).alias("_n1"))
    w = W.partitionBy(*by, "_p").orderBy("value")
    own = w.rowsBetween(W.unboundedPreceding, -1)
    local = values.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(f"_before{c}") for c in ("_a", "_b")], F.lead("value").over(w).alias("_next"))
    out = met(local, carried, [*by, "_p"])
    return out.withColumns({"_before_a": F.col("_before_a") + F.col("_oa"), "_before_b": F.col("_before_b") + F.col("_ob"), "_next": F.coalesce("_next", "_after")}).drop("_oa", "_ob", "_after")


def gaps() -> list[Column]:
    """The aggregates of ``cumulated`` rows that give both distances: wasserstein and ks."""
    gap = F.abs((F.col("_before_a") + F.col("_a")) / F.nullif("_n0", F.lit(0)) - (F.col("_before_b") + F.col("_b")) / F.nullif("_n1", F.lit(0)))
    return [F.sum(gap * F.coalesce(F.col("_next") - F.col("value"), F.lit(0.0))).alias("wasserstein"), F.max(gap).alias("ks")]


def sides() -> list[Column]:
    return [F.max("_n0").alias("_n0"), F.max("_n1").alias("_n1")]


def significance() -> Column:
    """The asymptotic p-value of ``ks`` between samples of _n0 and _n1."""
    return kolmogorov(F.sqrt(F.col("_n0") * F.col("_n1") / (F.col("_n0") + F.col("_n1"))) * F.col("ks"))


def binned(values: DataFrame, c: DataFrame, by: Sequence[str], bins: int, more: Sequence[Column] = ()) -> DataFrame:
    """by, _n0, _n1, psi, and the aggregates ``more`` of ``c``, the cumulated rows of ``values``."""
    found = {}
    for i in range(bins + 1):  # the two values between which a quantile lies, by their places
        place = (F.col("_n0") - 1) * F.lit(i / bins)
        for name, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            found[f"_{name}{i}"] = F.max(F.when((F.col("_before_a") <= at) & (at < F.col("_before_a") + F.col("_a")), F.col("value")))
    names = [n for n in ("wasserstein", "ks") if more]
    whole = c.groupBy(*by).agg(*sides(), *more, *[x.alias(n) for n, x in found.items()])
    edge = [(lambda p: F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (p - F.floor(p)))((F.col("_n0") - 1) * F.lit(i / bins)) for i in range(bins + 1)]
    whole = whole.select(*by, "_n0", "_n1", *names, F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.round(e, DIGITS) for e in edge])))).alias("_e"))
    inner = F.when(F.size("_e") > 2, F.slice("_e", 2, F.greatest(F.size("_e") - 2, F.lit(1)))).otherwise(F.array().cast("array<double>"))
    placed = met(values, whole.withColumn("_inner", inner), by).withColumn("_bin", F.size(F.filter("_inner", lambda e: e <= F.col("value"))))
    # the row of a group goes on with its bins, so that nothing is joined to it again
    carried = [F.first(n).alias(n) for n in ("_n0", "_n1", "_e", *names)]
    other = F.coalesce(F.sum(F.when(F.col("value") != F.get("_e", F.lit(0)), F.col("_b"))), F.lit(0))
    counts = placed.groupBy(*by, "_bin").agg(F.sum("_a").alias("_c0"), F.sum("_b").alias("_c1"), other.alias("_other"), *carried)
    p0, p1 = F.greatest(F.try_divide("_c0", "_n0"), F.lit(FLOOR)), F.greatest(F.try_divide("_c1", "_n1"), F.lit(FLOOR))
    # bins that neither sample reaches add nothing: both shares are at the floor; without a reference there are no bins
    out = counts.groupBy(*by).agg(F.sum(F.when(F.size("_e") > 0, (p1 - p0) * F.log(p1 / p0))).alias("_psi"), F.sum("_other").alias("_other"), *carried)
    constant = F.size("_e") == 1
    psi_value = F.when(constant & (F.col("_other") == 0), 0.0).when(constant, float("inf")).otherwise(F.col("_psi"))
    return out.select(*by, "_n0", "_n1", psi_value.alias("psi"), *names)


def measures(samples: DataFrame, by: Sequence[str] = ("feature",), bins: int = BINS, parts: int | None = None) -> DataFrame:
    """psi, wasserstein, ks and its asymptotic p-value, n_reference and n_current of each group, all from one count of the values.

    psi: over the reference's quantile bins, outer bins open, empty bins floored; a constant reference gives 0 if all current
    values equal it, else infinity. Distances are null where a side is empty, psi where the reference is."""
    values = ranged(samples, by, parts)
    c = cumulated(values, by)
    return binned(values, c, by, bins, gaps()).select(*by, "psi", "wasserstein", "ks", significance().alias("p_value"), F.col("_n0").alias("n_reference"), F.col("_n1").alias("n_current"))


def psi(samples: DataFrame, by: Sequence[str] = ("feature",), bins: int = BINS) -> DataFrame:
    """psi, n_reference and n_current, as ``measures`` has them."""
    values = ranged(samples, by)
    return binned(values, cumulated(values, by), by, bins).select(*by, "psi", F.col("_n0").alias("n_reference"), F.col("_n1").alias("n_current"))


def distribution_distance(samples: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """wasserstein, ks and p_value of the groups that both sides have; no bins are made."""
    c = cumulated(ranged(samples, by), by)
    return c.groupBy(*by).agg(*sides(), *gaps()).where((F.col("_n0") > 0) & (F.col("_n1") > 0)).select(*by, "wasserstein", "ks", significance().alias("p_value"))


def kolmogorov(x: Column, terms: int = 50) -> Column:
    """The upper tail of the Kolmogorov distribution."""
    total = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x))
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def feature_drift(samples: DataFrame, by: Sequence[str] = ("feature",), p: float = 0.05) -> DataFrame:
    """KS per feature: rounded statistic and p-value, and the flag."""
    d = distribution_distance(samples, by)
    return d.select(*by, F.round("ks", 4).alias("ks"), F.round("p_value", 4).alias("p_value"), (F.col("p_value") < p).alias("drifted"))


def log_returns(rows: DataFrame, time: str = "event_timestamp") -> DataFrame:
    step = F.log(F.when(F.col("close") > 0, F.col("close")))
    return rows.select("symbol", (step - F.lag(step).over(W.partitionBy("symbol").orderBy(time))).alias("value")).where("value is not null")


def target_drift(reference: DataFrame, current: DataFrame, time: str = "event_timestamp", max_psi: float = 0.2, max_wasserstein: float = 0.1) -> DataFrame:
    """One row on the log returns of both periods."""
    s = both(log_returns(reference, time), log_returns(current, time), []).withColumn("feature", F.lit("target"))
    return target_verdict(measures(s).join(moments(s), "feature"), max_psi, max_wasserstein)


def moments(samples: DataFrame) -> DataFrame:
    r, c = F.when(F.col("_side") == 0, F.col("value")), F.when(F.col("_side") == 1, F.col("value"))
    return samples.groupBy("feature").agg(F.avg(r).alias("ref_mean"), F.avg(c).alias("cur_mean"), F.stddev_pop(r).alias("ref_std"), F.stddev_pop(c).alias("cur_std"))


def target_verdict(measured: DataFrame, max_psi: float = 0.2, max_wasserstein: float = 0.1) -> DataFrame:
    few = (F.col("n_reference") < MIN_REFERENCE) | (F.col("n_current") < MIN_CURRENT)
    flag = ~few & ((F.col("psi") > max_psi) | (F.col("wasserstein") > max_wasserstein))
    numbers = ["psi", "wasserstein", "ref_mean", "cur_mean", "ref_std", "cur_std"]
    out = measured.withColumn("std_ratio", F.try_divide("cur_std", "ref_std"))
    return out.select(F.when(few, "insufficient_data").otherwise("ok").alias("status"), flag.alias("drift_detected"), "n_reference", "n_current", *[F.round(x, 6).alias(x) for x in [*numbers, "std_ratio"]])


def melt(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    wide = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "feature", "value")


def symbol_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], max_psi: float = 0.2) -> DataFrame:
    """Per symbol and feature: psi, wasserstein, whether it drifted, its rank by psi, and whether there are enough rows."""
    s = both(melt(reference, columns), melt(current, columns), ["symbol", "feature"])
    return symbol_verdicts(measures(s, ["symbol", "feature"]).drop("ks", "p_value"), max_psi)


def symbol_verdicts(measured: DataFrame, max_psi: float = 0.2) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("symbol").orderBy(F.desc("psi"), "feature"))
    enough = (F.col("n_reference") >= MIN_REFERENCE) & (F.col("n_current") >= MIN_CURRENT)
    return measured.withColumns({"enough": enough, "drifted": enough & (F.col("psi") > max_psi), "rank": rank})


def decision(reference: DataFrame, current: DataFrame, columns: Sequence[str], time: str = "event_timestamp", share: float = 0.2) -> DataFrame:
    """``decide`` on two periods: the features of every symbol and the target are measured together, from one count."""
    target = both(log_returns(reference, time), log_returns(current, time), []).select(F.lit(None).cast("string").alias("symbol"), F.lit("target").alias("feature"), "value", "_side")
    features = both(melt(reference, columns), melt(current, columns), ["symbol", "feature"])
    measured = measures(features.unionByName(target), ["symbol", "feature"])
    path = workspace(reference.sparkSession, "drift-measured")  # a row a symbol and feature, read twice below
    measured.write.parquet(path)
    measured = reference.sparkSession.read.schema(measured.schema).parquet(path)
    few = (F.col("n_reference") < MIN_REFERENCE) | (F.col("n_current") < MIN_CURRENT)
    one = measured.where("symbol is null").select(F.when(few, "insufficient_data").otherwise("ok").alias("status"), (~few & ((F.col("psi") > 0.2) | (F.col("wasserstein") > 0.1))).alias("drift_detected"))
    return decide(one, symbol_verdicts(measured.where("symbol is not null")), share)


#: Rows of a symbol and period that a forest is fitted to, about; the others are left out by their hash.
FOREST_ROWS = 4000


def adversarial_auc(reference: DataFrame, current: DataFrame, columns: Sequence[str], trees: int = 50, depth: int = 3, folds: int = 3, threshold: float = 0.7, most: int = FOREST_ROWS) -> DataFrame:
    """Per symbol: how well a forest tells the periods apart, averaged over folds by row hash, and its three main features.

    One job for all symbols: a group is a symbol and a fold, or a symbol's whole sample for the features. A symbol's sample is
    bounded by ``most`` rows a period, drawn by the hash of their values, so a group fits a task however much history there is.
    Rows with a null or NaN are left out; a symbol that only one period has gets no score."""
    names = list(columns)
    rows = reference.select("symbol", *names, F.lit(0).alias("label")).unionByName(current.select("symbol", *names, F.lit(1).alias("label")))
    rows = rows.dropna(subset=names).select("symbol", "label", *[F.col(c).cast("double").alias(c) for c in names], F.pmod(F.xxhash64(*names), F.lit(1 << 40)).alias("_h"))
    sizes = rows.groupBy("symbol", "label").agg(F.count("*").alias("_n"))
    kept = rows.join(sizes, ["symbol", "label"]).where(F.col("_h") < F.lit(float(most << 40)) / F.col("_n"))
    dealt = kept.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds)))).withColumn("test", F.pmod("_h", F.lit(folds)) == F.col("fold"))

    def fit(group: pa.Table) -> pa.Table:
        from tickspark.functions import forest

        symbol, fold = group["symbol"][0].as_py(), group["fold"][0].as_py()
        x = np.stack([group[c].to_numpy() for c in names], axis=1)
        y, test = group["label"].to_numpy().astype(float), group["test"].to_numpy()
        order = np.lexsort((y, *x.T))  # whatever order the rows came in
        x, y, test = forest.binned(x)[order], y[order], test[order]
        train = ~test
        model = forest.Forest(trees, depth, seed=fold).fit(x[train], y[train]) if train.any() else None
        found = forest.auc(model.score(x[test]), y[test]) if fold < folds and model else float("nan")
        weights = model.importance.tolist() if fold == folds and model else None
        return pa.table({"symbol": pa.array([symbol], pa.string()), "fold": pa.array([fold], pa.int32()), "auc": pa.array([None if found != found else found], pa.float64()), "weights": pa.array([weights], pa.list_(pa.float64()))})

    fitted = dealt.select("symbol", "fold", "label", "test", *names).groupBy("symbol", "fold").applyInArrow(fit, "symbol string, fold int, auc double, weights array<double>")
    by = fitted.groupBy("symbol").agg(F.avg("auc").alias("_auc"), F.max("weights").alias("_w")).where("_auc is not null")
    ranked = F.array_sort(F.arrays_zip(F.transform("_w", lambda x: -x).alias("w"), F.sequence(F.lit(0), F.lit(len(names) - 1)).alias("i")))
    listed = F.array(*[F.lit(c) for c in names])
    top = F.transform(F.slice(ranked, 1, 3), lambda r: F.get(listed, r["i"]))
    return by.select("symbol", F.round("_auc", 3).alias("auc"), (F.col("_auc") > threshold).alias("separable"), top.alias("top_features"))


def decide(target: DataFrame, symbols: DataFrame, share: float = 0.2) -> DataFrame:
    """One row: the share of drifted symbols, whether to retrain, and whether data are missing.

    A symbol that one period lacks has no decision: both must hold the same symbols (``unequal_universes`` names the others)."""
    lacking = symbols.where((F.coalesce("n_reference", F.lit(0)) == 0) | (F.coalesce("n_current", F.lit(0)) == 0)).groupBy().agg(F.count_distinct("symbol").alias("_n"))
    symbols = symbols.crossJoin(F.broadcast(lacking)).withColumn("_same", F.when(F.col("_n") == 0, True).otherwise(F.raise_error(F.lit("the periods hold different symbols")).cast("boolean"))).where("_same")
    per = symbols.groupBy("symbol").agg(F.max("drifted").alias("d"), F.min("enough").alias("e"))
    s = per.agg(F.count("*").alias("symbols"), F.count_if("d").alias("drifted"), F.count_if(~F.col("e")).alias("short"))
    t = target.select(F.col("drift_detected").alias("target_drifted"), (F.col("status") != "ok").alias("target_short"))
    d = s.crossJoin(F.broadcast(t)).withColumn("drifted_share", F.try_divide("drifted", "symbols"))
    return d.select("symbols", "drifted", "drifted_share", "target_drifted", ((F.col("drifted_share") >= share) | F.col("target_drifted")).alias("retrain"), ((F.col("short") > 0) | F.col("target_short")).alias("inconclusive"))


def unequal_universes(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(symbol, only_in) of symbols that one period lacks; a drift decision needs none."""
    r, c = reference.select("symbol").distinct(), current.select("symbol").distinct()
    return r.join(c, "symbol", "left_anti").withColumn("only_in", F.lit("reference")).unionByName(c.join(r, "symbol", "left_anti").withColumn("only_in", F.lit("current")))


def periods(rows: DataFrame, now: Column, reference_days: int = 180, current_days: int = 30, time: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """The rows of [now - reference_days, now - current_days) and of those since."""
    since, turn = now - F.expr(f"interval {reference_days} days"), now - F.expr(f"interval {current_days} days")
    return rows.where((F.col(time) >= since) & (F.col(time) < turn)), rows.where(F.col(time) >= turn)


def top_features(drift: DataFrame, by: str = "wasserstein", n: int = 3) -> DataFrame:
    """The ``n`` features of each symbol with the largest psi, wasserstein or importance."""
    w = W.partitionBy("symbol").orderBy(F.desc(by), "feature")
    return drift.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


#: Values that a sketch keeps at a level: exact up to so many, beyond them its rank error is below 0.2 %.
SKETCH = 2048
SKETCHED = "day date, symbol string, feature string, sketch binary"
#: The feature that holds log returns.
TARGET = "log_return"


def period_sketches(rows: DataFrame, columns: Sequence[str], time: str = "event_timestamp") -> DataFrame:
    """SKETCHED: a KLL sketch of the finite values of each (day, symbol, feature), log returns among the features.

    Days are sketched once, as they are loaded; a day's first return needs the row before it, so give that row with the day's."""
    step = F.log(F.when(F.col("close") > 0, F.col("close")))
    wide = rows.withColumn(TARGET, step - F.lag(step).over(W.partitionBy("symbol").orderBy(time)))
    v = F.round(F.col("value"), DIGITS)
    long = melt(wide.withColumn("day", F.to_date(time)), [*columns, TARGET], ("day", "symbol")).where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return long.groupBy("day", "symbol", "feature").agg(F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch"))


def sketch_drift(sketches: DataFrame, turn: Column, since: Column, by: Sequence[str] = ("symbol", "feature"), bins: int = BINS, steps: int = 1000) -> DataFrame:
    """psi, wasserstein, n_reference and n_current of each group from stored sketches: days in [since, turn) against days since ``turn``.

    Shares are counted over ``steps`` quantiles: with a rank error of e (SKETCH) a bin's share is off by 2 e + 1 / steps at
    most. Wasserstein is the mean distance of these quantiles."""
    cur = F.col("day") >= turn
    merged = sketches.where(F.col("day") >= since).groupBy(*by).agg(*[F.kll_merge_agg_double(F.when(side, F.col("sketch")), F.lit(SKETCH)).alias(n) for side, n in ((~cur, "_r"), (cur, "_c"))])
    n = {c: F.coalesce(F.kll_sketch_get_n_double(F.col(c)), F.lit(0)) for c in ("_r", "_c")}
    merged = merged.withColumns({"n_reference": n["_r"], "n_current": n["_c"]})
    at = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    fine = F.array(*[F.lit((i + 0.5) / steps) for i in range(steps)])

    def some(c: str, value: Column) -> Column:
        return F.when(F.col(f"n_{c}") > 0, value)

    q = merged.select(
        "*",
        some("reference", F.array_distinct(F.transform(F.kll_sketch_get_quantile_double("_r", at), lambda x: F.round(x, DIGITS)))).alias("_e"),
        some("reference", F.kll_sketch_get_quantile_double("_r", fine)).alias("_fr"),
        some("current", F.kll_sketch_get_quantile_double("_c", fine)).alias("_fc"),
        some("current", F.kll_sketch_get_quantile_double("_c", F.array(F.lit(0.0), F.lit(1.0)))).alias("_span"),
    )
    inner = F.when(F.size("_e") > 2, F.slice("_e", 2, F.greatest(F.size("_e") - 2, F.lit(1)))).otherwise(F.array().cast("array<double>"))
    q = q.withColumn("_inner", inner)

    def shares(points: str) -> Column:
        """Shares of the bins from how many of the fine quantiles lie below each inner edge."""
        below = F.transform("_inner", lambda e: F.size(F.filter(points, lambda x: x < e)) / F.lit(float(steps)))
        return F.zip_with(F.concat(below, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), below), lambda b, a: F.greatest(b - a, F.lit(FLOOR)))

    terms = F.zip_with(shares("_fr"), shares("_fc"), lambda a, b: (b - a) * F.log(b / a))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    constant = F.size("_e") == 1
    same = (F.element_at("_span", 1) == F.element_at("_e", 1)) & (F.element_at("_span", 2) == F.element_at("_e", 1))
    both_there = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    value = F.when(~both_there, F.lit(None).cast("double")).when(constant & same, 0.0).when(constant, float("inf")).otherwise(total)
    distance = F.aggregate(F.zip_with("_fr", "_fc", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda x, y: x + y) / steps
    return q.select(*by, value.alias("psi"), distance.alias("wasserstein"), "n_reference", "n_current")


def sketch_decision(sketches: DataFrame, now: Column, reference_days: int = 180, current_days: int = 30, share: float = 0.2) -> DataFrame:
    """``decide`` on the whole days of [now - reference_days, now - current_days) and those since, from sketches alone."""
    since, turn = F.to_date(now - F.expr(f"interval {reference_days} days")), F.to_date(now - F.expr(f"interval {current_days} days"))
    symbols = sketch_drift(sketches.where(F.col("feature") != TARGET), turn, since)
    target = sketch_drift(sketches.where(F.col("feature") == TARGET), turn, since, ["feature"])
    few = (F.col("n_reference") < MIN_REFERENCE) | (F.col("n_current") < MIN_CURRENT)
    one = target.select(F.when(few, "insufficient_data").otherwise("ok").alias("status"), (~few & ((F.col("psi") > 0.2) | (F.col("wasserstein") > 0.1))).alias("drift_detected"))
    return decide(one, symbol_verdicts(symbols), share)
