"""Evaluation, drift, universe and operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import drift as D
from tickspark.operators import evaluation as E
from tickspark.operators import monitoring as M
from tickspark.operators import universe as U
from tickspark.operators.pointintime import latest_per_key
from tickspark.plans.common import BARS, TRADES, read, register, trades
from tickspark.plans.features import at, labelled
from tickspark.plans.market import ROLLING, half_hours, rolling_features, rounded
from tickspark.sources.tables import workspace

#: Paths of 13 steps from the events; the second model is worse.
SAMPLES = """smp AS (SELECT event_id // 13 AS sample_id, (event_id % 13 + 1)::INTEGER AS horizon, (value - 50) / 10000 AS y_true, (value - 50) / 20000 + (event_id % 7 - 3) / 1000.0::DOUBLE AS m, (value - 50) / 40000 + (event_id % 5 - 2) / 500.0::DOUBLE AS m2 FROM events),
  fc AS (SELECT sample_id, horizon, q AS quantile, y_true, m + (q - 0.5) * 0.01 AS y_pred, m2 + (q - 0.5) * 0.01 AS y_pred2, (sample_id % 3)::INTEGER AS "window" FROM smp, (SELECT unnest([0.1::DOUBLE, 0.5, 0.9]) AS q))"""


def forecasts(spark, d, model=1):
    k = F.col("event_id")
    m = (F.col("value") - 50) / 20000 + (k % 7 - 3) / 1000.0 if model == 1 else (F.col("value") - 50) / 40000 + (k % 5 - 2) / 500.0
    s = read(spark, d, "events").select(F.floor(k / 13).alias("sample_id"), (k % 13 + 1).cast("int").alias("horizon"), ((F.col("value") - 50) / 10000).alias("y_true"), m.alias("m"))
    q = s.select("*", F.explode(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("quantile"))
    return q.select("sample_id", "horizon", "quantile", "y_true", (F.col("m") + (F.col("quantile") - 0.5) * 0.01).alias("y_pred"), (F.col("sample_id") % 3).cast("int").alias("window"))


WIDE = f"""{SAMPLES}, w AS (SELECT "window", horizon, sample_id, any_value(y_true) AS y, avg(greatest(quantile * (y_true - y_pred), (quantile - 1) * (y_true - y_pred))) AS loss, max(y_pred) FILTER (quantile = 0.1) AS lo, max(y_pred) FILTER (quantile = 0.9) AS hi, max(y_pred) FILTER (quantile = 0.5) AS m FROM fc GROUP BY ALL),
  hz AS (SELECT horizon, avg(loss) AS pinball, avg((y >= lo AND y <= hi)::INT) AS coverage, avg(hi - lo) AS interval_width, avg(abs(y - m)) AS mae, sqrt(avg((y - m) * (y - m))) AS rmse, avg(CASE WHEN abs(y) + abs(m) = 0 THEN 0 ELSE abs(y - m) / ((abs(y) + abs(m)) / 2) END) AS smape, sum(abs(y - m)) / sum(abs(y)) AS wape FROM w GROUP BY horizon)"""
ROUNDED = ", ".join(f"round({c}, 8) AS {c}" for c in E.METRICS)


@register("forecast_metrics_by_horizon", f"WITH {WIDE} SELECT horizon, {ROUNDED} FROM hz")
def forecast_metrics_by_horizon(spark, d):
    return rounded(E.metrics_by_horizon(forecasts(spark, d)), *E.METRICS)


@register("forecast_metrics_overall", f"WITH {WIDE} SELECT " + ", ".join(f"round(avg({c}), 8) AS {c}" for c in E.METRICS) + " FROM hz")
def forecast_metrics_overall(spark, d):
    return rounded(E.overall(E.metrics_by_horizon(forecasts(spark, d))), *E.METRICS)


def evidence_sql(pred: str, by: str = "") -> str:
    b = f'"{by}", ' if by else ""
    g = f'GROUP BY "{by}"' if by else ""
    return f"""SELECT {b}count(DISTINCT sample_id) AS sample_count, avg(abs(y_true)) AS baseline_mae, avg(abs(y_true - {pred})) AS mae, 0::BIGINT AS crossings, 0::BIGINT AS non_finite, (avg(abs(y_true)) - avg(abs(y_true - {pred}))) / avg(abs(y_true)) AS baseline_mae_improvement FROM fc WHERE quantile = 0.5 {g}"""


@register(
    "evaluation_evidence",
    f"WITH {SAMPLES}, e AS ({evidence_sql('y_pred')}), c AS (SELECT max(e) AS x FROM (SELECT abs(avg((y_true <= y_pred)::INT) - quantile) AS e FROM fc GROUP BY horizon, quantile)) SELECT sample_count, round(baseline_mae, 8) AS baseline_mae, round(mae, 8) AS mae, crossings, non_finite, round(baseline_mae_improvement, 8) AS baseline_mae_improvement, round(x, 8) AS maximum_calibration_error FROM e, c",
)
def evaluation_evidence(spark, d):
    return rounded(E.evidence(forecasts(spark, d)), "baseline_mae", "mae", "baseline_mae_improvement", "maximum_calibration_error")


DIRECTION = """(SELECT {b} avg(abs(y_true - {p})) AS mae, coalesce(avg(CASE WHEN abs(y_true) > 0.001 THEN (sign(y_true) = CASE WHEN abs({p}) > 0.001 THEN sign({p}) ELSE 0 END)::INT END), 0) AS hit_rate FROM fc WHERE quantile = 0.5 {g})"""


@register("directional_score", f"WITH {SAMPLES}, s AS {DIRECTION.format(b='', p='y_pred', g='')} SELECT round(mae, 8) AS mae, round(hit_rate, 8) AS hit_rate, round(0.7 * hit_rate - 0.3 * mae, 8) AS composite_score FROM s")
def directional_score(spark, d):
    return rounded(E.directional(forecasts(spark, d)), "mae", "hit_rate", "composite_score")


WINDOWS = f"""{SAMPLES}, a AS {DIRECTION.format(b='"window",', p='y_pred', g='GROUP BY "window"')}, b AS {DIRECTION.format(b='"window",', p='y_pred2', g='GROUP BY "window"')},
  a2 AS (SELECT *, 0.7 * hit_rate - 0.3 * mae AS score FROM a), b2 AS (SELECT *, 0.7 * hit_rate - 0.3 * mae AS score FROM b)"""


@register("window_stability", f"WITH {WINDOWS} SELECT round(avg(mae), 8) AS mae, round(avg(hit_rate), 8) AS hit_rate, round(avg(score), 8) AS composite_score, round(stddev_pop(score), 8) AS stability, count(*) AS windows FROM a2")
def window_stability(spark, d):
    return rounded(E.stability(E.directional(forecasts(spark, d), ["window"])), "mae", "hit_rate", "composite_score", "stability")


def window_metrics(spark, d, model):
    f = forecasts(spark, d, model)
    m = E.evidence(f, ["window"]).drop("mae").join(E.directional(f, ["window"]), "window")
    gates = E.horizon_gates(E.metrics_by_horizon(f, by=["window"]), ["window"], {"max_mae": 0.05, "min_coverage": 0.05})
    return E.failures(m).join(gates, "window")


FAIL = f"""ev AS ({evidence_sql('y_pred', 'window')}), cal AS (SELECT "window", max(e) AS x FROM (SELECT "window", abs(avg((y_true <= y_pred)::INT) - quantile) AS e FROM fc GROUP BY "window", horizon, quantile) GROUP BY 1),
  fl AS (SELECT ev."window", list_filter([CASE WHEN sample_count < 100 THEN 'insufficient_samples' END, CASE WHEN baseline_mae_improvement < 0.02 THEN 'baseline_not_beaten' END, CASE WHEN x > 0.10 THEN 'poor_calibration' END], lambda v: v IS NOT NULL) AS failures FROM ev JOIN cal USING ("window"))"""


@register("qualification_failures", f"""WITH {SAMPLES}, {FAIL} SELECT "window", array_to_string(failures, ',') AS failures FROM fl""")
def qualification_failures(spark, d):
    return window_metrics(spark, d, 1).select("window", F.array_join("failures", ",").alias("failures"))


@register(
    "promotion_decision",
    f"""WITH {WINDOWS}, {FAIL}, gate AS (SELECT "window", bool_or(mae > 0.05 OR coverage < 0.05) AS bad FROM (SELECT "window", horizon, avg(abs(y - m)) AS mae, avg((y >= lo AND y <= hi)::INT) AS coverage FROM (SELECT "window", horizon, sample_id, any_value(y_true) AS y, max(y_pred) FILTER (quantile = 0.1) AS lo, max(y_pred) FILTER (quantile = 0.9) AS hi, max(y_pred) FILTER (quantile = 0.5) AS m FROM fc GROUP BY ALL) GROUP BY ALL) GROUP BY 1),
s AS (SELECT (SELECT count(*) FROM a2) AS windows, (SELECT avg(score) FROM a2) AS score, (SELECT avg(mae) FROM a2) AS mae, (SELECT stddev_pop(score) FROM a2) AS stability, (SELECT avg(score) FROM b2) AS champion_score, (SELECT avg(mae) FROM b2) AS champion_mae, (SELECT avg((a2.score > b2.score)::INT) FROM a2 JOIN b2 USING ("window")) AS win_fraction),
r AS (SELECT *, (score - champion_score) / abs(champion_score) AS improvement FROM s)
SELECT windows, windows AS paired, round(win_fraction, 8) AS win_fraction, round(score, 8) AS score, round(champion_score, 8) AS champion_score, round(improvement, 8) AS improvement, round(stability, 8) AS stability, reasons, reasons = '' AS approved FROM (SELECT *, array_to_string(list_concat((SELECT coalesce(list_sort(list_distinct(flatten(list(failures)))), []) FROM fl), list_filter([
  CASE WHEN windows < 3 THEN 'insufficient_evaluation_windows' END, CASE WHEN (SELECT bool_or(bad) FROM gate) THEN 'horizon_gates' END, CASE WHEN stability > 0.1 THEN 'unstable_metrics' END, CASE WHEN windows < 3 THEN 'insufficient_paired_windows' END,
  CASE WHEN win_fraction < 0.66 THEN 'insufficient_window_wins' END, CASE WHEN mae > champion_mae * 1.1 THEN 'mae_degradation' END, CASE WHEN improvement IS NULL OR improvement <= 0.02 THEN 'insufficient_improvement' END], lambda v: v IS NOT NULL)), ',') AS reasons FROM r)""",
)
def promotion_decision(spark, d):
    out = E.promotion(window_metrics(spark, d, 1), window_metrics(spark, d, 2))
    return rounded(out, "win_fraction", "score", "champion_score", "improvement", "stability")


OFFSETS = f"""{SAMPLES}, run AS (SELECT sample_id, horizon, sum(y_true - y_pred) OVER w AS r, sum(y_pred) OVER w AS m FROM fc WHERE quantile = 0.5 WINDOW w AS (PARTITION BY sample_id ORDER BY horizon)),
  o3 AS (SELECT horizon, count(*) AS paths, quantile_cont(r, [0.1, 0.5, 0.9]) AS o FROM run GROUP BY horizon HAVING count(*) >= 30), off AS (SELECT horizon, paths, unnest([0.1::DOUBLE, 0.5, 0.9]) AS quantile, unnest(o) AS "offset" FROM o3)"""


@register("calibration_offsets", f'WITH {OFFSETS} SELECT horizon, paths, quantile, round("offset", 8) AS "offset" FROM off')
def calibration_offsets(spark, d):
    return rounded(E.residual_offsets(forecasts(spark, d)), "offset")


def bases(spark, d):
    return forecasts(spark, d).select("sample_id").distinct().withColumn("base_price", 100.0 + F.col("sample_id") % 50)


PRICES = f"{OFFSETS}, pr AS (SELECT sample_id, run.horizon, quantile, (100.0 + sample_id % 50)::DOUBLE AS base_price, (100.0 + sample_id % 50)::DOUBLE * exp(m + \"offset\") AS price FROM run JOIN off ON run.horizon = off.horizon)"


@register("price_paths", f"WITH {PRICES} SELECT sample_id, horizon, quantile, round(price, 6) AS price FROM pr")
def price_paths(spark, d):
    f = forecasts(spark, d)
    return rounded(E.price_paths(f, E.residual_offsets(f), bases(spark, d)), "price", digits=6)


@register("forecast_table", f"WITH {PRICES} SELECT sample_id, horizon, round(max(price) FILTER (quantile = 0.1), 4) AS p10, round(max(price) FILTER (quantile = 0.5), 4) AS p50, round(max(price) FILTER (quantile = 0.9), 4) AS p90, round(max(price) FILTER (quantile = 0.5) / any_value(base_price) - 1, 4) + 0.0 AS change, TRUE AS ordered FROM pr GROUP BY sample_id, horizon")
def forecast_table(spark, d):
    f = forecasts(spark, d)
    return E.forecast_table(E.price_paths(f, E.residual_offsets(f), bases(spark, d)), bases(spark, d))


COLUMNS = ["close", "high", "low", "total_volume"]


def periods(spark, d):
    b = labelled(spark, d)
    return b.where(F.col("event_timestamp") < at()), b.where(F.col("event_timestamp") >= at())


MELTED = f"""{BARS}, s AS (SELECT symbol, feature, round(value, 6) AS value, (window_end >= TIMESTAMP '2024-01-20 00:00:00')::INT AS side FROM (SELECT symbol, window_end, unnest(['close', 'high', 'low', 'total_volume']) AS feature, unnest([close, high, low, total_volume::DOUBLE]) AS value FROM bars))"""
PSI = """e AS (SELECT {by}, list_sort(list_distinct(list_transform(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), lambda x: round(x, 6)))) AS e FROM s WHERE side = 0 GROUP BY ALL),
  bn AS (SELECT {by}, len(list_filter(e[2:len(e) - 1], lambda x: x <= value)) AS bin, count(*) FILTER (side = 0) AS c0, count(*) FILTER (side = 1) AS c1 FROM s JOIN e USING ({by}) GROUP BY ALL),
  sh AS (SELECT *, greatest(c0 / sum(c0) OVER (PARTITION BY {by}), 1e-6) AS p0, greatest(c1 / sum(c1) OVER (PARTITION BY {by}), 1e-6) AS p1 FROM bn),
  psi AS (SELECT {by}, sum((p1 - p0) * ln(p1 / p0)) AS psi, sum(c0)::BIGINT AS n_reference, sum(c1)::BIGINT AS n_current FROM sh GROUP BY ALL)"""
DIST = """dv AS (SELECT {by}, value, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM s GROUP BY ALL),
  cu AS (SELECT {by}, value, abs(sum(a) OVER w / sum(a) OVER p - sum(b) OVER w / sum(b) OVER p) AS gap, lead(value) OVER w - value AS step, sum(a) OVER p AS n0, sum(b) OVER p AS n1 FROM dv WINDOW w AS (PARTITION BY {by} ORDER BY value), p AS (PARTITION BY {by})),
  di AS (SELECT {by}, coalesce(sum(gap * step), 0) AS wasserstein, max(gap) AS ks, any_value(n0) AS n0, any_value(n1) AS n1 FROM cu GROUP BY ALL)"""


@register("psi", f"WITH {MELTED}, {PSI.format(by='symbol, feature')} SELECT symbol, feature, round(psi, 8) AS psi, n_reference, n_current FROM psi")
def psi(spark, d):
    ref, cur = periods(spark, d)
    s = D.both(D.melt(ref, COLUMNS), D.melt(cur, COLUMNS), ["symbol", "feature"])
    return rounded(D.psi(s, ["symbol", "feature"]), "psi")


@register("wasserstein", f"WITH {MELTED}, {DIST.format(by='symbol, feature')} SELECT symbol, feature, round(wasserstein, 6) AS wasserstein FROM di")
def wasserstein(spark, d):
    ref, cur = periods(spark, d)
    s = D.both(D.melt(ref, COLUMNS), D.melt(cur, COLUMNS), ["symbol", "feature"])
    return D.distribution_distance(s, ["symbol", "feature"]).select("symbol", "feature", F.round("wasserstein", 6).alias("wasserstein"))


KS = """ksp AS (SELECT *, sqrt(n0 * n1 / (n0 + n1)) * ks AS x FROM di), kst AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 51), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x))))) END AS p FROM ksp)"""


@register("ks_statistic", f"WITH {MELTED}, {DIST.format(by='feature')}, {KS} SELECT feature, round(ks, 4) AS ks, round(p, 4)::DOUBLE AS p_value, p < 0.05 AS drifted FROM kst")
def ks_statistic(spark, d):
    ref, cur = periods(spark, d)
    return D.feature_drift(D.both(D.melt(ref, COLUMNS), D.melt(cur, COLUMNS), ["feature"]))


TARGET = f"""{BARS}, lr AS (SELECT symbol, window_end, ln(close) - ln(lag(close) OVER (PARTITION BY symbol, side ORDER BY window_end)) AS v, side FROM (SELECT *, (window_end >= TIMESTAMP '2024-01-20 00:00:00')::INT AS side FROM bars)),
  s AS (SELECT 'target' AS feature, round(v, 6) AS value, side FROM lr WHERE v IS NOT NULL), {PSI.format(by='feature')}, {DIST.format(by='feature')},
  mo AS (SELECT avg(value) FILTER (side = 0) AS ref_mean, avg(value) FILTER (side = 1) AS cur_mean, stddev_pop(value) FILTER (side = 0) AS ref_std, stddev_pop(value) FILTER (side = 1) AS cur_std FROM s),
  td AS (SELECT 'ok' AS status, psi > 0.2 OR wasserstein > 0.1 AS drift_detected, n_reference, n_current, psi, wasserstein, mo.*, cur_std / ref_std AS std_ratio FROM psi, di, mo)"""


@register("target_drift", f"WITH {TARGET} SELECT status, drift_detected, n_reference, n_current, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("psi", "wasserstein", "ref_mean", "cur_mean", "ref_std", "cur_std", "std_ratio")) + " FROM td")
def target_drift(spark, d):
    return D.target_drift(*periods(spark, d))


SYMBOL = f"{MELTED}, {PSI.format(by='symbol, feature')}, {DIST.format(by='symbol, feature')}, sd AS (SELECT symbol, feature, psi, wasserstein, psi > 0.2 AS drifted, row_number() OVER (PARTITION BY symbol ORDER BY psi DESC, feature) AS rank FROM psi JOIN di USING (symbol, feature))"


@register("top_drift_features", f"WITH {SYMBOL} SELECT symbol, feature, round(psi, 6) AS psi, round(wasserstein, 6) AS wasserstein, drifted, rank::INTEGER AS rank FROM sd WHERE rank <= 3")
def top_drift_features(spark, d):
    top = D.symbol_drift(*periods(spark, d), COLUMNS).where("rank <= 3")
    return rounded(top, "psi", "wasserstein", digits=6).select("symbol", "feature", "psi", "wasserstein", "drifted", "rank")


@register("drift_decision", f"WITH {SYMBOL}, g AS (SELECT symbol, bool_or(drifted) AS dr FROM sd GROUP BY symbol) SELECT count(*) AS symbols, count(*) FILTER (dr) AS drifted, (count(*) FILTER (dr))::DOUBLE / count(*) AS drifted_share, (WITH {TARGET} SELECT drift_detected FROM td) AS target_drifted, (count(*) FILTER (dr))::DOUBLE / count(*) >= 0.2 OR (WITH {TARGET} SELECT drift_detected FROM td) AS retrain, FALSE AS inconclusive FROM g")
def drift_decision(spark, d):
    return D.decision(*periods(spark, d), COLUMNS)


#: Whole days before and since 2024-01-20; the first of January is day 19 before it.
DAYS = f"""{BARS}, r AS (SELECT symbol, window_end, close, high, low, total_volume::DOUBLE AS total_volume, ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY window_end)) AS log_return, (window_end >= TIMESTAMP '2024-01-20 00:00:00')::INT AS side FROM bars),
  lr AS (SELECT 'log_return' AS feature, round(log_return, 6) AS value, side FROM r WHERE log_return IS NOT NULL), tp AS (WITH s AS (FROM lr), {PSI.format(by='feature')} SELECT psi FROM psi), tw AS (WITH s AS (FROM lr), {DIST.format(by='feature')} SELECT wasserstein FROM di)"""


@register(
    "drift_from_sketches",
    f"""WITH {MELTED}, {PSI.format(by='symbol, feature')}, g AS (SELECT symbol, bool_or(psi > 0.2) AS dr FROM psi GROUP BY symbol),
t AS (WITH {DAYS} SELECT tp.psi > 0.2 OR tw.wasserstein > 0.1 AS td FROM tp, tw)
SELECT count(*) AS symbols, count(*) FILTER (dr) AS drifted, (count(*) FILTER (dr))::DOUBLE / count(*) AS drifted_share, (SELECT td FROM t) AS target_drifted, (count(*) FILTER (dr))::DOUBLE / count(*) >= 0.2 OR (SELECT td FROM t) AS retrain, FALSE AS inconclusive FROM g""",
)
def drift_from_sketches(spark, d):
    """Days are sketched once; the report reads the sketches."""
    w = workspace(spark, "sketches")
    jobs.sketch_days(labelled(spark, d), w, COLUMNS)
    return jobs.drift_report(spark, w, F.lit("2024-02-19 00:00:00").cast("timestamp_ntz"), 180, 30)


@register("symbol_drift_auc")
def symbol_drift_auc(spark, d):
    return D.adversarial_auc(*periods(spark, d), COLUMNS)


COMPANIES = r"""co AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN chr(160) || 'c' || c_custkey || ' ' ELSE 'C' || c_custkey END AS symbol, c_name AS company_name, c_mktsegment AS sector, c_custkey FROM customer),
  cl AS (SELECT upper(trim(replace(symbol, chr(160), ' '))) AS symbol, company_name, sector, c_custkey FROM co)"""


def companies(spark, d):
    k = F.col("c_custkey")
    odd = F.concat(F.lit("\u00a0c"), k.cast("string"), F.lit(" "))
    return read(spark, d, "customer").select(F.when(k % 11 == 0, odd).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("symbol"), F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("sector"), k)


@register("universe_clean", f"WITH {COMPANIES} SELECT symbol, min(company_name) AS company_name, min(sector) AS sector, count(DISTINCT (company_name, sector)) > 1 AS conflicting, regexp_full_match(symbol, '[A-Z][A-Z0-9.-]{{0,9}}') AS valid FROM cl GROUP BY symbol")
def universe_clean(spark, d):
    return U.clean(companies(spark, d))


@register("universe_checks", f"WITH {COMPANIES}, g AS (SELECT symbol, count(DISTINCT (company_name, sector)) > 1 AS c FROM cl GROUP BY symbol) SELECT count(*) AS members, count(*) FILTER (NOT regexp_full_match(symbol, '[A-Z][A-Z0-9.-]{{0,9}}')) AS invalid, count(*) FILTER (c) AS conflicting, count(*) BETWEEN 450 AND 550 AND count(*) FILTER (c) = 0 AS passed FROM g")
def universe_checks(spark, d):
    return U.candidate_checks(U.clean(companies(spark, d)))


@register("universe_churn", f"WITH {COMPANIES}, p AS (SELECT DISTINCT symbol FROM cl WHERE c_custkey % 10 <> 0), c AS (SELECT DISTINCT symbol FROM cl WHERE c_custkey % 13 <> 0), n AS (SELECT (SELECT count(*) FROM p) AS previous, (SELECT count(*) FROM c WHERE symbol NOT IN (FROM p)) AS added, (SELECT count(*) FROM p WHERE symbol NOT IN (FROM c)) AS removed) SELECT *, greatest(added, removed)::DOUBLE / previous AS churn, greatest(added, removed)::DOUBLE / previous <= 0.1 AS accepted FROM n")
def universe_churn(spark, d):
    c = companies(spark, d)
    return U.churn(U.clean(c.where("c_custkey % 10 <> 0")), U.clean(c.where("c_custkey % 13 <> 0")))


@register(
    "universe_digest",
    f"""WITH {COMPANIES}, c AS (SELECT symbol, min(company_name) AS company_name, min(sector) AS sector FROM cl GROUP BY symbol), l AS (SELECT symbol, concat_ws(',', symbol, company_name, sector) AS line FROM c),
p AS (SELECT left(sha256(coalesce(symbol, '')), 2) AS b, sha256(string_agg(sha256(line), '' ORDER BY sha256(line))) AS h, count(*) AS n, sum(strlen(line)) AS s FROM l GROUP BY 1)
SELECT sum(n)::BIGINT AS members, sum(s)::BIGINT AS bytes, sha256(string_agg(b || h, '' ORDER BY b || h)) AS digest FROM p""",
)
def universe_digest(spark, d):
    return U.artifact_digest(U.clean(companies(spark, d)))


REQUESTS = """rq AS (SELECT ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value / 100 AS latency, event_id % 3 = 0 AS cached FROM events),
  ro AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS requests, (count(*) FILTER (status >= 500))::DOUBLE / count(*) AS error_ratio, quantile_cont(latency, 0.95) AS p95_latency, (count(*) FILTER (cached))::DOUBLE / count(*) AS hit_ratio FROM rq GROUP BY 1)"""


def requests(spark, d):
    return read(spark, d, "events").select("ts", F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), (F.col("value") / 100).alias("latency"), (F.col("event_id") % 3 == 0).alias("cached"))


@register("slo_rollup", f"WITH {REQUESTS} SELECT window_start, requests, error_ratio, round(p95_latency, 8) AS p95_latency, hit_ratio FROM ro")
def slo_rollup(spark, d):
    return rounded(M.slo_rollup(requests(spark, d)), "p95_latency")


@register(
    "alert_conditions",
    f"""WITH {REQUESTS}, h AS (SELECT *, epoch(window_start)::BIGINT AS t, sum(error_ratio * requests) OVER w / sum(requests) OVER w AS hour_error_ratio FROM ro WINDOW w AS (ORDER BY epoch(window_start)::BIGINT RANGE BETWEEN 3300 PRECEDING AND CURRENT ROW)),
c AS (SELECT window_start, t, round(hour_error_ratio, 8) AS hour_error_ratio, error_ratio > 0.05 AND hour_error_ratio > 0.01 AS availability_burn, p95_latency > 1.0 AS slow FROM h)
SELECT window_start, hour_error_ratio, availability_burn, slow, count(*) FILTER (availability_burn) OVER (ORDER BY t RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) = 2 AS burn_firing, count(*) FILTER (slow) OVER (ORDER BY t RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) = 3 AS slow_firing FROM c""",
)
def alert_conditions(spark, d):
    return rounded(M.burn(M.slo_rollup(requests(spark, d))), "hour_error_ratio").select("window_start", "hour_error_ratio", "availability_burn", "slow", "burn_firing", "slow_firing")


@register(
    "slo_sliding_hour",
    """WITH rq AS (SELECT ts, event_type = 'error' AS bad, value / 100 AS latency, event_id % 3 = 0 AS cached, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM events),
w AS (SELECT DISTINCT window_start FROM rq), j AS (SELECT w.window_start, bad, latency, cached FROM w JOIN rq ON rq.window_start BETWEEN w.window_start - INTERVAL 55 MINUTE AND w.window_start)
SELECT window_start, count(*) AS requests, (count(*) FILTER (bad))::DOUBLE / count(*) AS error_ratio, round(quantile_disc(latency, 0.95), 8) AS p95_latency, (count(*) FILTER (cached))::DOUBLE / count(*) AS hit_ratio FROM j GROUP BY 1""",
)
def slo_sliding_hour(spark, d):
    return rounded(M.sliding_slo(M.slo_slices(requests(spark, d))), "p95_latency")


@register("alerts_firing", f"WITH {BARS}, f AS (SELECT symbol, window_start, min((high - low > 20)::INT) OVER w = 1 AND count(*) OVER w = 3 AS firing FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) SELECT * FROM f")
def alerts_firing(spark, d):
    return M.held_for(half_hours(spark, d).select("symbol", "window_start", "high", "low"), F.col("high") - F.col("low") > 20, 3, ["symbol"], "window_start").select("symbol", "window_start", "firing")


@register("readiness", f"WITH {BARS}, l AS (SELECT symbol, max(window_end) AS cutoff, arg_max(close, window_end) AS offline_close FROM bars GROUP BY symbol) SELECT symbol, cutoff, offline_close, (offline_close::FLOAT)::DOUBLE AS online_close, cutoff >= TIMESTAMP '2024-01-30 21:00:00' AS fresh, TRUE AS parity, cutoff >= TIMESTAMP '2024-01-30 21:00:00' AS ready FROM l")
def readiness(spark, d):
    b = labelled(spark, d)
    online = latest_per_key(b, ["close"]).withColumn("close", F.col("close").cast("float").cast("double"))
    return M.readiness(online, b, F.lit("2024-01-30 21:00:00").cast("timestamp_ntz"))
