"""Publication, point-in-time joins and training frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark.operators import pointintime as P
from tickspark.operators import release as R
from tickspark.operators import training as TR
from tickspark.operators.bars import last_rows
from tickspark.plans.common import BARS, SYMBOLS, TRADES, read, register, trades
from tickspark.plans.market import ROLLING, half_hours, rolling_features, rounded
from tickspark.plans.sessions import LISTED
from tickspark.sources import bucketed
from tickspark.sources.tables import workspace

SPLIT = "2024-01-20 00:00:00"


def at():
    return F.lit(SPLIT).cast("timestamp_ntz")


SIDES = f"""{BARS}, old AS (SELECT symbol, window_start, close, total_volume FROM bars WHERE window_start < TIMESTAMP '2024-01-20 00:00:00'),
  new AS (SELECT symbol, window_start, CASE WHEN day(window_start) % 2 = 0 THEN close + 1 ELSE close END AS close, total_volume FROM bars WHERE window_start >= TIMESTAMP '2024-01-18 00:00:00')"""


def sides(spark, d):
    b = half_hours(spark, d).select("symbol", "window_start", "close", "total_volume")
    new = b.where(F.col("window_start") >= F.lit("2024-01-18").cast("timestamp_ntz")).withColumn("close", F.when(F.dayofmonth("window_start") % 2 == 0, F.col("close") + 1).otherwise(F.col("close")))
    return b.where(F.col("window_start") < at()), new


@register("upsert_bars", f"WITH {SIDES} SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (symbol, window_start)")
def upsert_bars(spark, d):
    return R.upsert(*sides(spark, d))


@register("insert_if_absent", f"WITH {SIDES} SELECT * FROM new ANTI JOIN old USING (symbol, window_start)")
def insert_if_absent(spark, d):
    return R.insert_if_absent(*sides(spark, d))


@register("incremental_rows", f"WITH {SIDES} SELECT new.* FROM new LEFT JOIN (SELECT symbol, max(window_start) AS m FROM old GROUP BY symbol) USING (symbol) WHERE m IS NULL OR window_start > m")
def incremental_rows(spark, d):
    old, new = sides(spark, d)
    return R.newer_rows(new, old)


@register("overlap_conflicts", f"WITH {SIDES} SELECT symbol, window_start FROM old JOIN new USING (symbol, window_start) WHERE old.close IS DISTINCT FROM new.close OR old.total_volume IS DISTINCT FROM new.total_volume")
def overlap_conflicts(spark, d):
    return R.overlap_conflicts(*sides(spark, d), ["close", "total_volume"])


#: One release a day; every seventh is pending, every fifth historical.
LEDGER = """led AS (SELECT 'r' || strftime(d, '%Y%m%d') AS dataset_id, CASE WHEN day(d) % 7 = 0 THEN 'pending' ELSE 'complete' END AS status, day(d) % 5 = 0 AS historical, d + INTERVAL 1 DAY AS max_event_time FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS d FROM events))"""


def ledger(spark, d):
    days = trades(spark, d).select(F.to_date("event_time").alias("d")).distinct()
    day = F.dayofmonth("d")
    return days.select(
        F.concat(F.lit("r"), F.date_format("d", "yyyyMMdd")).alias("dataset_id"), F.when(day % 7 == 0, "pending").otherwise("complete").alias("status"),
        F.to_json(F.struct((day % 5 == 0).alias("historical"))).alias("manifest"), F.date_add("d", 1).cast("timestamp_ntz").alias("max_event_time"), F.col("d").cast("timestamp_ntz").alias("updated_at"),
    )


def versioned(spark, d):
    return half_hours(spark, d).select("symbol", F.col("window_end").alias("event_timestamp"), "close", F.concat(F.lit("r"), F.date_format("window_start", "yyyyMMdd")).alias("dataset_version"))


VERSIONED = f"{BARS}, ver AS (SELECT symbol, window_end AS event_timestamp, close, 'r' || strftime(window_start, '%Y%m%d') AS dataset_version FROM bars), {LEDGER}"


@register("sliding_snapshot", f"WITH {VERSIONED}, h AS (SELECT * FROM ver WHERE dataset_version IN (SELECT dataset_id FROM led WHERE status = 'complete')) SELECT dataset_version, symbol, event_timestamp, close FROM h WHERE event_timestamp >= (SELECT max(event_timestamp) FROM h) - INTERVAL 10 DAY")
def sliding_snapshot(spark, d):
    return R.sliding_snapshot(versioned(spark, d), ledger(spark, d), 10)


@register("legacy_snapshot", f"WITH {VERSIONED} SELECT symbol, event_timestamp, close, dataset_version FROM ver WHERE event_timestamp >= TIMESTAMP '2024-01-24 00:00:00' - INTERVAL 10 DAY")
def legacy_snapshot(spark, d):
    v = versioned(spark, d)
    return R.legacy_snapshot(v.where(F.col("event_timestamp") < at()), v.unionByName(v), F.lit("2024-01-24").cast("timestamp_ntz"), 10)


@register("latest_publication", f"WITH {LEDGER} SELECT arg_max(dataset_id, max_event_time) AS dataset_id, max(max_event_time) AS max_event_time FROM led WHERE status = 'complete' AND NOT historical")
def latest_publication(spark, d):
    return R.latest_publication(ledger(spark, d))


@register("publication_checks", f"""WITH {LEDGER} SELECT count(*) FILTER (dataset_id = 'r20240112' AND status = 'complete') AS already_complete, count(*) FILTER (dataset_id <> 'r20240112' AND status = 'pending') AS others_pending,
  count(*) FILTER (dataset_id = 'r20240112') > 1 AS listed_twice, count(*) FILTER (dataset_id <> 'r20240112' AND status = 'complete' AND NOT historical AND max_event_time > TIMESTAMP '2024-01-13 00:00:00') AS newer_complete FROM led""")
def publication_checks(spark, d):
    return R.publication_checks(ledger(spark, d), F.lit("r20240112"), F.lit("2024-01-13").cast("timestamp_ntz"))


@register("training_rows", f"WITH {SIDES} SELECT symbol, window_start, close, total_volume FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (symbol, window_start)")
def training_rows(spark, d):
    old, new = sides(spark, d)
    return R.by_priority([new, old])


SPAN = "span AS (SELECT date_trunc('day', min(ts))::TIMESTAMP AS a, date_trunc('day', max(ts))::TIMESTAMP AS b FROM events)"
SPINE = f"{SPAN}, spine AS (SELECT symbol, unnest(generate_series(a, b, INTERVAL 6 HOUR)) AS event_timestamp FROM span, (SELECT unnest([{LISTED}]) AS symbol))"


def spine(spark, d):
    span = trades(spark, d).agg(F.date_trunc("day", F.min("event_time").cast("timestamp")).cast("timestamp_ntz").alias("start"), F.date_trunc("day", F.max("event_time").cast("timestamp")).cast("timestamp_ntz").alias("end"))
    return P.entity_spine(span, SYMBOLS, "6 hours")


@register("entity_spine", f"WITH {SPINE} SELECT symbol, event_timestamp FROM spine")
def entity_spine(spark, d):
    return spine(spark, d)


ASOF = f"""{ROLLING}, {SPINE} SELECT s.symbol, s.event_timestamp, CASE WHEN ok THEN close END AS close, CASE WHEN ok THEN rolling_avg_close END AS rolling_avg_close, CASE WHEN ok THEN window_end END AS feature_timestamp
FROM (SELECT s.symbol, s.event_timestamp, f.close, f.rolling_avg_close, f.window_end, f.window_end >= s.event_timestamp - INTERVAL 2 HOUR AS ok FROM spine s ASOF LEFT JOIN f ON s.symbol = f.symbol AND s.event_timestamp >= f.window_end) s"""


@register("asof_features", ASOF)
def asof_features(spark, d):
    f = rolling_features(spark, d).withColumn("event_timestamp", F.col("window_end"))
    return P.asof(spine(spark, d), f, ["close", "rolling_avg_close"], "2 hours")


def table_in(spark, name):
    """A name and a folder for a bucketed table."""
    path = workspace(spark, name)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


@register("asof_features_bucketed", ASOF)
def asof_features_bucketed(spark, d):
    """The same from a history in buckets."""
    f = rolling_features(spark, d).withColumn("event_timestamp", F.col("window_end"))
    name, path = table_in(spark, "history")
    columns = ["close", "rolling_avg_close"]
    bucketed.write_history(f, name, columns, "2 hours", path)
    return bucketed.asof_history(spine(spark, d), name, columns, "2 hours")


ONLINE = f"{BARS}, online AS (SELECT symbol, max(window_end) AS event_timestamp, arg_max(close, window_end) AS close, arg_max(total_volume, window_end) AS total_volume FROM bars GROUP BY symbol)"


def labelled(spark, d):
    return half_hours(spark, d).withColumn("event_timestamp", F.col("window_end"))


@register("online_latest", f"WITH {ONLINE} SELECT * FROM online")
def online_latest(spark, d):
    b = labelled(spark, d)
    first = P.latest_per_key(b.where(F.col("event_timestamp") <= at()), ["close", "total_volume"])
    return P.materialise(first, b, at(), F.lit("2025-01-01").cast("timestamp_ntz"), ["close", "total_volume"])


@register("online_lookup", f"WITH {ONLINE} SELECT r.symbol, event_timestamp, close, o.symbol IS NULL AS missing FROM (SELECT unnest(['click', 'view', 'nobody']) AS symbol) r LEFT JOIN online o ON r.symbol = o.symbol")
def online_lookup(spark, d):
    request = spark.createDataFrame([("click",), ("view",), ("nobody",)], "symbol string")
    return P.look_up(request, P.latest_per_key(labelled(spark, d), ["close"])).select("symbol", "event_timestamp", "close", "missing")


@register("online_lookup_bucketed", f"WITH {ONLINE} SELECT r.symbol, event_timestamp, close, o.symbol IS NULL AS missing FROM (SELECT unnest(['click', 'view', 'nobody']) AS symbol) r LEFT JOIN online o ON r.symbol = o.symbol")
def online_lookup_bucketed(spark, d):
    name, path = table_in(spark, "online")
    bucketed.write_online(P.latest_per_key(labelled(spark, d), ["close"]), name, path)
    return bucketed.look_up(spark, name, ["click", "view", "nobody"]).select("symbol", "event_timestamp", "close", "missing")


@register("online_parity", f"WITH {ONLINE} SELECT symbol, close AS offline, (close::FLOAT)::DOUBLE AS online, TRUE AS agrees FROM online")
def online_parity(spark, d):
    latest = P.latest_per_key(labelled(spark, d), ["close"])
    return P.parity(latest, latest.withColumn("close", F.col("close").cast("float")))


@register("history_plus_online", f"WITH {BARS} SELECT symbol, window_end AS event_timestamp, CASE WHEN window_end = max(window_end) OVER (PARTITION BY symbol) THEN close + 0.5 ELSE close END AS close FROM bars")
def history_plus_online(spark, d):
    h = labelled(spark, d).select("symbol", "event_timestamp", "close")
    return P.with_online(h, P.latest_per_key(h, ["close"]).withColumn("close", F.col("close") + 0.5))


@register("feature_page", f"WITH {BARS} SELECT symbol, window_end AS event_timestamp, close, n > 100 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) AS r, count(*) OVER (PARTITION BY symbol) AS n FROM bars) WHERE r <= 100")
def feature_page(spark, d):
    return P.page(labelled(spark, d).select("symbol", "event_timestamp", "close"), 100)


@register("latest_rows", f"WITH {BARS} SELECT symbol, window_start, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS r FROM bars) WHERE r <= 60")
def latest_rows(spark, d):
    return last_rows(half_hours(spark, d), 60).select("symbol", "window_start", "close")


@register("min_history", f"WITH {BARS} SELECT symbol, count(DISTINCT (window_end - INTERVAL 5 HOUR)::DATE) AS sessions, count(DISTINCT (window_end - INTERVAL 5 HOUR)::DATE) >= 20 AS enough FROM bars GROUP BY symbol")
def min_history(spark, d):
    return TR.min_history(labelled(spark, d), 20)


@register(
    "model_frame",
    f"""{ROLLING} SELECT symbol, window_end AS event_timestamp, row_number() OVER (PARTITION BY symbol ORDER BY window_end)::INTEGER - 1 + 1 AS time_idx, CASE WHEN (window_end - INTERVAL 5 HOUR)::DATE IN (DATE '2024-01-01', DATE '2024-01-15') THEN '1.0' ELSE '0.0' END AS is_holiday,
  '0.0' AS is_early_close, hour(window_end)::INTEGER AS hour, minute(window_end)::INTEGER AS minute, (isodow(window_end) - 1)::VARCHAR AS day_of_week, round(sin(hour(window_end) * 2 * pi() / 24), 8) + 0.0 AS hour_sin, round(cos((isodow(window_end) - 1) * 2 * pi() / 7), 8) AS dow_cos,
  round(ln(1 + total_volume), 8) AS log_volume, round(ln(close), 8) AS log_close, round(ln(close) - ln(p), 8) AS target FROM f WHERE p IS NOT NULL""",
)
def model_frame(spark, d):
    m = TR.model_frame(labelled(spark, d))
    m = m.select("symbol", "event_timestamp", "time_idx", "is_holiday", "is_early_close", "hour", "minute", "day_of_week", "hour_sin", "dow_cos", "log_volume", "log_close", "target")
    return rounded(m, "hour_sin", "dow_cos", "log_volume", "log_close", "target").withColumn("hour_sin", F.col("hour_sin") + 0.0)


SPLITS = f"""{BARS}, rows AS (SELECT symbol, window_end AS event_timestamp, close, row_number() OVER (PARTITION BY symbol ORDER BY window_end)::INTEGER - 1 AS time_idx FROM bars),
  times AS (SELECT event_timestamp, row_number() OVER (ORDER BY event_timestamp) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT event_timestamp FROM rows)),
  cut AS (SELECT max(event_timestamp) AS cutoff FROM times WHERE i <= floor(n * (1 - 0.2::DOUBLE))),
  train AS (SELECT rows.* FROM rows, cut WHERE event_timestamp <= cutoff), holdout AS (SELECT rows.* FROM rows, cut WHERE event_timestamp > cutoff),
  bound AS (SELECT symbol, count(*) AS train_rows, max(time_idx) AS training_last_idx FROM train GROUP BY symbol)"""
ENCODER, HORIZON = 96, 13


def splits(spark, d):
    return TR.temporal_split(labelled(spark, d).select("symbol", "event_timestamp", "close"), 0.2, ENCODER, HORIZON)


@register("split_cutoff", f"WITH {SPLITS} SELECT cutoff FROM cut")
def split_cutoff(spark, d):
    return TR.cutoff(labelled(spark, d))


@register("split_train", f"WITH {SPLITS} SELECT symbol, event_timestamp, close, time_idx FROM train")
def split_train(spark, d):
    return splits(spark, d)[0]


@register("split_validation", f"WITH {SPLITS} SELECT symbol, event_timestamp, close, time_idx FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_timestamp DESC) AS r FROM train) WHERE r <= 96 UNION ALL SELECT symbol, event_timestamp, close, time_idx FROM holdout")
def split_validation(spark, d):
    return splits(spark, d)[1]


@register("split_boundaries", f"WITH {SPLITS} SELECT symbol, train_rows, training_last_idx, coalesce(h, 0) AS holdout_rows, train_rows >= 96 AND coalesce(h, 0) >= 13 AS sufficient FROM bound LEFT JOIN (SELECT symbol, count(*) AS h FROM holdout GROUP BY symbol) USING (symbol)")
def split_boundaries(spark, d):
    return splits(spark, d)[2]


INDEX = f"""{SPLITS}, val AS (SELECT symbol, event_timestamp, time_idx FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_timestamp DESC) AS r FROM train) WHERE r <= 96 UNION ALL SELECT symbol, event_timestamp, time_idx FROM holdout),
  idx AS (SELECT v.symbol, time_idx AS time_idx_first_prediction, least(time_idx + 12, b) AS time_idx_last, time_idx > training_last_idx AS in_holdout FROM val v JOIN (SELECT symbol, min(time_idx) AS a, max(time_idx) AS b FROM val GROUP BY symbol) s USING (symbol) JOIN bound USING (symbol) WHERE time_idx - a >= 48)"""


def index(spark, d):
    _, val, bound = splits(spark, d)
    return TR.decoder_index(val, bound, ENCODER, HORIZON)


@register("decoder_index", f"WITH {INDEX} SELECT * FROM idx")
def decoder_index(spark, d):
    return index(spark, d)


@register("leakage_check", f"WITH {INDEX}, st AS (SELECT DISTINCT symbol, unnest(generate_series(time_idx_first_prediction, time_idx_last)) AS time_idx FROM idx) SELECT st.symbol, st.time_idx::INTEGER AS time_idx, event_timestamp FROM st LEFT JOIN rows USING (symbol, time_idx), cut WHERE event_timestamp IS NULL OR event_timestamp <= cutoff")
def leakage_check(spark, d):
    rows = labelled(spark, d).select("symbol", "event_timestamp", "close")
    _, val, bound = TR.temporal_split(rows, 0.2, ENCODER, HORIZON)
    return TR.leaks(TR.decoder_index(val, bound, ENCODER, HORIZON), TR.time_index(rows, "event_timestamp"), TR.cutoff(rows))


@register(
    "purged_windows",
    f"""WITH {INDEX}, o AS (SELECT t, ntile(3) OVER (ORDER BY t)::INTEGER AS w FROM (SELECT DISTINCT time_idx_first_prediction AS t FROM idx WHERE in_holdout)), r AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY t DESC) AS r FROM o)
SELECT time_idx_first_prediction, symbol, time_idx_last, w AS "window" FROM idx JOIN r ON t = time_idx_first_prediction WHERE in_holdout AND (w = 3 OR r > 13)""",
)
def purged_windows(spark, d):
    return TR.purged_windows(index(spark, d).where("in_holdout").drop("in_holdout"), 3, HORIZON)


def indexed(spark, d):
    return TR.time_index(labelled(spark, d).select("symbol", "event_timestamp", "close"), "event_timestamp")


def summary(encoder, decoder, value):
    """What the queries return of an example's arrays."""
    total = F.aggregate(encoder, F.lit(0.0), lambda a, x: a + value(x))
    return [F.size(encoder).alias("encoder_length"), F.size(decoder).alias("decoder_length"), value(F.element_at(encoder, 1)).alias("encoder_first"), value(F.element_at(decoder, -1)).alias("decoder_last"), F.round(total, 6).alias("encoder_sum")]


def examples_sql(encoder, horizon):
    return f"""WITH {SPLITS}, e AS (SELECT symbol, time_idx, count(*) OVER a AS encoder_length, count(*) OVER b AS decoder_length, first_value(close) OVER a AS encoder_first, last_value(close) OVER b AS decoder_last, round(sum(close) OVER a, 6) AS encoder_sum FROM rows
  WINDOW a AS (PARTITION BY symbol ORDER BY time_idx ROWS BETWEEN {encoder} PRECEDING AND 1 PRECEDING), b AS (PARTITION BY symbol ORDER BY time_idx ROWS BETWEEN CURRENT ROW AND {horizon - 1} FOLLOWING))
SELECT symbol, time_idx, encoder_length::INTEGER AS encoder_length, decoder_length::INTEGER AS decoder_length, encoder_first, decoder_last, encoder_sum FROM e WHERE encoder_length >= {encoder // 2}"""


def packed(spark, d, encoder, horizon):
    ex = TR.packed_examples(indexed(spark, d), ["close"], encoder, horizon)
    return ex.select("symbol", "time_idx", *summary("close_encoder", "close_decoder", lambda x: x))


@register("sequence_examples", examples_sql(ENCODER, HORIZON))
def sequence_examples(spark, d):
    """Every origin, cut from blocks."""
    return packed(spark, d, ENCODER, HORIZON)


@register("sequence_examples_long", examples_sql(780, 39))
def sequence_examples_long(spark, d):
    """The production lengths: 780 steps back and 39 ahead."""
    return packed(spark, d, 780, 39)


@register("sequence_examples_all", examples_sql(ENCODER, HORIZON))
def sequence_examples_all(spark, d):
    """Every origin, as frames of a window."""
    ex = TR.sequence_examples(indexed(spark, d), ["close"], ENCODER, HORIZON)
    return ex.select("symbol", "time_idx", *summary("encoder", "decoder", lambda x: x["close"]))
