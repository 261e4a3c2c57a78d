"""Forecast metrics, qualification, promotion and price paths. Forecasts are long: sample_id, horizon, quantile, y_true, y_pred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOW, MEDIAN, HIGH = 0.1, 0.5, 0.9


def nearest(quantiles: Sequence[float], wanted: float) -> float:
    """The wanted quantile, or the one next to it."""
    return min(quantiles, key=lambda q: (abs(q - wanted), quantiles.index(q)))


def _at(q: float) -> Column:
    return F.max(F.when(F.col("quantile") == q, F.col("y_pred")))


def metrics_by_horizon(forecasts: DataFrame, quantiles: Sequence[float] = (LOW, MEDIAN, HIGH), by: Sequence[str] = (), interval: tuple[float, float] = (LOW, HIGH), median: float = MEDIAN) -> DataFrame:
    """Pinball loss, coverage, width, MAE, RMSE, sMAPE and WAPE of each horizon; a zero denominator gives 0."""
    low, high, mid = (nearest(list(quantiles), q) for q in (*interval, median))
    y, q = F.col("y_true"), F.col("quantile")
    loss = F.greatest(q * (y - F.col("y_pred")), (q - 1) * (y - F.col("y_pred")))
    sample = forecasts.groupBy(*by, "horizon", "sample_id").agg(F.first("y_true").alias("y"), F.avg(loss).alias("loss"), _at(low).alias("lo"), _at(high).alias("hi"), _at(mid).alias("m"))
    error, scale = F.abs(F.col("y") - F.col("m")), (F.abs("y") + F.abs("m")) / 2
    return sample.groupBy(*by, "horizon").agg(
        F.avg("loss").alias("pinball"),
        F.avg(((F.col("y") >= F.col("lo")) & (F.col("y") <= F.col("hi"))).cast("double")).alias("coverage"),
        F.avg(F.col("hi") - F.col("lo")).alias("interval_width"),
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.when(scale == 0, 0.0).otherwise(error / F.nullif(scale, F.lit(0.0)))).alias("smape"),
        F.coalesce(F.try_divide(F.sum(error), F.sum(F.abs("y"))), F.lit(0.0)).alias("wape"),
    )


METRICS = ("pinball", "coverage", "interval_width", "mae", "rmse", "smape", "wape")


def overall(by_horizon: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The mean of the horizons."""
    return by_horizon.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS])


def evidence(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """sample_count, baseline_mae (no change), mae, baseline_mae_improvement, maximum_calibration_error, and what disqualifies:
    crossing quantiles and values that aren't finite."""
    wrong = F.isnan("y_true") | F.isnan("y_pred") | (F.abs("y_true") == float("inf")) | (F.abs("y_pred") == float("inf"))
    steps = forecasts.groupBy(*by, "sample_id", "horizon").agg(F.array_sort(F.collect_list(F.struct("quantile", "y_pred"))).alias("_q"), F.first("y_true").alias("y"), F.max(wrong).alias("_wrong"), _at(MEDIAN).alias("m"))
    crossing = F.exists(F.sequence(F.lit(2), F.greatest(F.size("_q"), F.lit(2))), lambda i: F.coalesce(F.get("_q", i - 1)["y_pred"] < F.get("_q", i - 2)["y_pred"], F.lit(False)))
    base = steps.groupBy(*by).agg(
        F.count_distinct("sample_id").alias("sample_count"), F.avg(F.abs("y")).alias("baseline_mae"), F.avg(F.abs(F.col("y") - F.col("m"))).alias("mae"),
        F.count_if(crossing).alias("crossings"), F.count_if("_wrong").alias("non_finite"),
    )
    base = base.withColumn("baseline_mae_improvement", F.when(F.col("baseline_mae") > 0, (F.col("baseline_mae") - F.col("mae")) / F.col("baseline_mae")).otherwise(float("nan")))
    off = forecasts.groupBy(*by, "horizon", "quantile").agg(F.abs(F.avg((F.col("y_true") <= F.col("y_pred")).cast("double")) - F.col("quantile")).alias("_e"))
    off = off.groupBy(*by).agg(F.max("_e").alias("maximum_calibration_error"))
    return base.join(off, list(by)) if by else base.crossJoin(F.broadcast(off))


def directional(forecasts: DataFrame, by: Sequence[str] = (), band: float = 0.001, weights: tuple[float, float] = (0.7, 0.3)) -> DataFrame:
    """MAE of the medians, hit rate over moves beyond the dead band, and their composite score."""
    m = forecasts.where(F.col("quantile") == MEDIAN)

    def sign(c: str) -> Column:
        return F.when(F.abs(c) > band, F.signum(c)).otherwise(0.0)

    hit = F.coalesce(F.avg(F.when(sign("y_true") != 0, (sign("y_true") == sign("y_pred")).cast("double"))), F.lit(0.0))
    out = m.groupBy(*by).agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"), hit.alias("hit_rate"))
    return out.withColumn("composite_score", weights[0] * F.col("hit_rate") - weights[1] * F.col("mae"))


def stability(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return windows.groupBy(*by).agg(F.avg("mae").alias("mae"), F.avg("hit_rate").alias("hit_rate"), F.avg("composite_score").alias("composite_score"), F.stddev_pop("composite_score").alias("stability"), F.count("*").alias("windows"))


#: The limits of the promotion policy; the reasons below are fixed as well.
POLICY = {"samples": 100, "gain": 0.02, "calibration": 0.10, "windows": 3, "wins": 0.66, "stability": 0.10, "improvement": 0.02, "degradation": 0.10}


def failures(metrics: DataFrame, policy: dict = POLICY) -> DataFrame:
    """``metrics`` with failures, an array of reasons; one reason stands for all where a metric is missing or not finite."""
    needed = ("mae", "hit_rate", "composite_score", "sample_count", "baseline_mae", "baseline_mae_improvement", "maximum_calibration_error")
    wrong = F.lit(False)
    for c in needed:
        x = F.col(c).cast("double")
        wrong = wrong | x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    found = F.array_compact(
        F.array(
            F.when(F.col("sample_count") < policy["samples"], "insufficient_samples"),
            F.when(F.col("baseline_mae_improvement") < policy["gain"], "baseline_not_beaten"),
            F.when(F.col("maximum_calibration_error") > policy["calibration"], "poor_calibration"),
        )
    )
    return metrics.withColumn("failures", F.when(wrong, F.array(F.lit("missing_or_nonfinite_metrics"))).otherwise(found))


def horizon_gates(by_horizon: DataFrame, by: Sequence[str], limits: dict[str, float]) -> DataFrame:
    """passed: no horizon breaks a limit (max_wape, max_mae, max_smape, min_coverage)."""
    bad = F.lit(False)
    for name, limit in limits.items():
        kind, metric = name.split("_", 1)
        bad = bad | (F.col(metric) > limit if kind == "max" else F.col(metric) < limit)
    return by_horizon.groupBy(*by).agg((F.count_if(bad) == 0).alias("gates_passed"))


def promotion(challenger: DataFrame, champion: DataFrame, policy: dict = POLICY) -> DataFrame:
    """One decision row from the window metrics of both (window, failures, gates_passed, mae, composite_score)."""
    c = challenger.agg(
        F.count("*").alias("windows"), F.flatten(F.collect_list("failures")).alias("_f"), F.count_if(~F.col("gates_passed")).alias("_gates"),
        F.avg("composite_score").alias("score"), F.avg("mae").alias("mae"), F.stddev_pop("composite_score").alias("stability"),
    )
    p = champion.agg(F.avg("composite_score").alias("champion_score"), F.avg("mae").alias("champion_mae"))
    pairs = challenger.select("window", F.col("composite_score").alias("a")).join(champion.select("window", F.col("composite_score").alias("b")), "window")
    wins = pairs.agg(F.count("*").alias("paired"), F.coalesce(F.avg((F.col("a") > F.col("b")).cast("double")), F.lit(0.0)).alias("win_fraction"))
    d = c.crossJoin(p).crossJoin(wins)  # one row each
    gain = F.try_divide(F.col("score") - F.col("champion_score"), F.abs("champion_score"))
    d = d.withColumn("improvement", gain)
    reasons = F.concat(
        F.array_sort(F.array_distinct("_f")),
        F.array_compact(
            F.array(
                F.when(F.col("windows") < policy["windows"], "insufficient_evaluation_windows"),
                F.when(F.col("_gates") > 0, "horizon_gates"),
                F.when(F.col("stability") > policy["stability"], "unstable_metrics"),
                F.when(F.col("paired") < policy["windows"], "insufficient_paired_windows"),
                F.when(F.col("win_fraction") < policy["wins"], "insufficient_window_wins"),
                F.when(F.col("mae") > F.col("champion_mae") * (1 + policy["degradation"]), "mae_degradation"),
                F.when(F.col("improvement").isNull() | (F.col("improvement") <= policy["improvement"]), "insufficient_improvement"),
            )
        ),
    )
    d = d.withColumn("reasons", F.array_join(reasons, ","))
    return d.select("windows", "paired", "win_fraction", "score", "champion_score", "improvement", "stability", "reasons", (F.col("reasons") == "").alias("approved"))


def residual_offsets(forecasts: DataFrame, quantiles: Sequence[float] = (LOW, MEDIAN, HIGH), least: int = 30) -> DataFrame:
    """Quantiles over samples of the running residual of the median, for each horizon with enough paths."""
    m = forecasts.where(F.col("quantile") == MEDIAN)
    run = F.sum(F.col("y_true") - F.col("y_pred")).over(W.partitionBy("sample_id").orderBy("horizon"))
    paths = m.select("horizon", run.alias("_r")).groupBy("horizon").agg(F.count("*").alias("paths"), F.percentile("_r", F.array(*[F.lit(q) for q in quantiles])).alias("_o")).where(F.col("paths") >= least)
    return paths.select("horizon", "paths", F.inline(F.arrays_zip(F.array(*[F.lit(q) for q in quantiles]).alias("quantile"), F.col("_o").alias("offset")))).toDF("horizon", "paths", "quantile", "offset")


def price_paths(forecasts: DataFrame, offsets: DataFrame, base: DataFrame) -> DataFrame:
    """Prices of every quantile: the base price of the sample grown by the running median and shifted by the offset."""
    m = forecasts.where(F.col("quantile") == MEDIAN)
    run = m.select("sample_id", "horizon", F.sum("y_pred").over(W.partitionBy("sample_id").orderBy("horizon")).alias("_m"))
    out = run.join(F.broadcast(offsets.select("horizon", "quantile", "offset")), "horizon").join(base, "sample_id")
    return out.select("sample_id", "horizon", "quantile", (F.col("base_price") * F.exp(F.col("_m") + F.col("offset"))).alias("price"))


def price_table(prices: DataFrame, base: DataFrame, quantiles: Sequence[float] = (LOW, MEDIAN, HIGH)) -> DataFrame:
    """One row a sample and horizon: a price for each quantile (p10, p50, p90) and the base price."""
    names = [f"p{round(q * 100)}" for q in quantiles]
    return prices.groupBy("sample_id", "horizon").agg(*[F.max(F.when(F.col("quantile") == q, F.col("price"))).alias(n) for q, n in zip(quantiles, names, strict=True)]).join(base, "sample_id")


def forecast_table(prices: DataFrame, base: DataFrame, quantiles: Sequence[float] = (LOW, MEDIAN, HIGH)) -> DataFrame:
    """One row a sample and horizon: p10, p50, p90, the change against the base, all to 4 digits, and whether they are ordered."""
    names = [f"p{round(q * 100)}" for q in quantiles]
    wide = price_table(prices, base, quantiles)
    change = F.round(F.col(names[1]) / F.col("base_price") - 1, 4) + 0.0  # no negative zero
    ordered = (F.col(names[0]) <= F.col(names[1])) & (F.col(names[1]) <= F.col(names[2]))
    return wide.select("sample_id", "horizon", *[F.round(n, 4).alias(n) for n in names], change.alias("change"), ordered.alias("ordered"))


def returns_to_prices(rows: DataFrame, kind: str = "log") -> DataFrame:
    """(sample_id, horizon, value, base_price) to the price after each step."""
    step = F.col("value") if kind == "log" else F.log1p("value")
    return rows.withColumn("price", F.col("base_price") * F.exp(F.sum(step).over(W.partitionBy("sample_id").orderBy("horizon"))))


def calibration_error(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per quantile: the mean over the horizons of |share of outcomes at or below the forecast - quantile|."""
    step = forecasts.groupBy(*by, "horizon", "quantile").agg(F.avg((F.col("y_true") <= F.col("y_pred")).cast("double")).alias("_observed"))
    return step.groupBy(*by, "quantile").agg(F.avg(F.abs(F.col("_observed") - F.col("quantile"))).alias("calibration_error"))
