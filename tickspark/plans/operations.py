"""Replay, ingestion health, alerts, the governed universe, publication checks and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickspark import jobs
from tickspark.operators import coverage as V
from tickspark.operators import drift as D
from tickspark.operators import evaluation as E
from tickspark.operators import monitoring as M
from tickspark.operators import pointintime as P
from tickspark.operators import quality as Q
from tickspark.operators import release as R
from tickspark.operators import training as TR
from tickspark.operators import universe as U
from tickspark.plans.common import BARS, FAULTY, GAPPY, SYMBOLS, TRADES, faulty, read, register, trades
from tickspark.plans.features import INDEX, ONLINE, index, labelled, versioned
from tickspark.plans.live import faulty_stream, stream_of
from tickspark.plans.market import gappy, half_hours, rounded
from tickspark.plans.models import SAMPLES, forecasts, requests
from tickspark.plans.sessions import GRID, sess
from tickspark.sources import releases, tables
from tickspark.sources import trades as T
from tickspark.sources.tables import workspace
from tickspark.streaming import live


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Replay of a range of records: the events as three partitions


#: Some records are missing, some are read twice.
RECORDS = f"""{FAULTY}, rec AS (SELECT event_id % 3 AS "partition", event_id // 3 AS "offset", CASE WHEN event_id % 61 = 0 THEN 'no json' ELSE '' END AS text, faulty.* FROM faulty),
  bounds AS (SELECT "partition", min("offset") AS start, max("offset") + 1 AS end_exclusive FROM rec GROUP BY 1)"""


def records(spark, d):
    k = F.col("event_id")
    value = F.when(k % 61 == 0, "no json").otherwise(F.to_json(F.struct("symbol", "price", "volume", "timestamp")))
    return faulty(spark, d).select(F.lit("trades").alias("topic"), (k % 3).alias("partition"), F.floor(k / 3).alias("offset"), value.alias("value"), k, "symbol", "price", "event_time")


def bounds(spark, d):
    return records(spark, d).groupBy("partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end_exclusive"))


@register(
    "replay_reconciliation",
    f"""WITH {RECORDS}, got AS (SELECT "partition", "offset", CASE WHEN event_id % 97 = 0 THEN 2 ELSE 1 END AS n FROM rec WHERE event_id % 50 <> 7),
g AS (SELECT "partition", count(*) AS offsets, sum(n - 1)::BIGINT AS repeated, min("offset") AS first, max("offset") AS last FROM got GROUP BY 1)
SELECT "partition", start, end_exclusive, end_exclusive - start AS expected, coalesce(offsets, 0) AS offsets, coalesce(repeated, 0) AS repeated, first, last, coalesce(offsets, 0) = end_exclusive - start AS complete FROM bounds LEFT JOIN g USING ("partition")""",
)
def replay_reconciliation(spark, d):
    got = records(spark, d).where(F.col("event_id") % 50 != 7)
    return T.reconcile(got.unionByName(got.where(F.col("event_id") % 97 == 0)), bounds(spark, d))


REASON = """CASE WHEN text <> '' THEN 'unreadable' WHEN NOT coalesce(symbol IN ('click', 'view', 'signup', 'purchase', 'error'), FALSE) THEN 'symbol' WHEN NOT coalesce(price > 0, FALSE) THEN 'price'
  WHEN NOT coalesce(volume > 0, FALSE) THEN 'volume' WHEN timestamp IS NULL THEN 'timestamp' END"""


@register("replay_quarantine", f"""WITH {RECORDS}, q AS (SELECT "partition", "offset", {REASON} AS reason FROM rec) SELECT "partition", "offset", reason FROM q WHERE reason IS NOT NULL""")
def replay_quarantine(spark, d):
    return T.replay(records(spark, d), SYMBOLS)[1].select("partition", "offset", "reason")


@register("replay_trades", f"""WITH {RECORDS}, q AS (SELECT *, {REASON} AS reason FROM rec) SELECT "partition", "offset", symbol, price, volume::DOUBLE AS volume, timestamp FROM q WHERE reason IS NULL""")
def replay_trades(spark, d):
    return T.replay(records(spark, d), SYMBOLS)[0].select("partition", "offset", "symbol", "price", "volume", "timestamp")


@register(
    "recovery_report",
    f"""WITH {RECORDS}, q AS (SELECT *, {REASON} AS reason FROM rec), g AS (SELECT symbol, timestamp, price, volume, count(*) AS n FROM q WHERE reason IS NULL GROUP BY ALL)
SELECT (SELECT count(*) FROM q WHERE reason IS NULL) AS valid_rows, (SELECT count(*) FROM q WHERE reason IS NOT NULL) AS rejected_rows, (SELECT sum(n - 1)::BIGINT FROM g) AS identical_trade_payloads,
  (SELECT sum(end_exclusive - start)::BIGINT FROM bounds) AS expected, (SELECT count(*) FROM q) = (SELECT sum(end_exclusive - start) FROM bounds) AS complete""",
)
def recovery_report(spark, d):
    return jobs.recovery_report(records(spark, d), bounds(spark, d), SYMBOLS)


@register("wire_decoded", f"WITH {FAULTY} SELECT symbol, price, volume::DOUBLE AS volume, timestamp, timestamp AS event_ms FROM faulty WHERE event_id % 61 <> 0 UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM faulty WHERE event_id % 61 = 0")
def wire_decoded(spark, d):
    return T.decode(records(spark, d)).select("symbol", "price", "volume", "timestamp", F.unix_millis("event_time").alias("event_ms"))


@register("csv_round_trip", f"WITH {BARS} SELECT symbol, window_start, window_end, open, high, low, close, total_volume::DOUBLE AS total_volume FROM bars")
def csv_round_trip(spark, d):
    path = workspace(spark, "csv")
    order = ["window_start", "window_end", "symbol", "open", "high", "low", "close", "total_volume"]
    half_hours(spark, d).select(order).write.option("header", True).csv(f"{path}/bars")
    return T.csv_bars(spark, f"{path}/bars").withColumns({c: F.col(c).cast("timestamp_ntz") for c in order[:2]})


# Health and alerts


@register("partition_offsets", """SELECT event_id % 3 AS "partition", count(*) AS messages, max(event_id // 3) AS last_offset FROM events GROUP BY 1""")
def partition_offsets(spark, d):
    return M.partition_offsets(records(spark, d))


@register(
    "symbol_age",
    f"""WITH {TRADES}, l AS (SELECT symbol, max(event_time) AS last_trade FROM trades GROUP BY symbol)
SELECT s.symbol, last_trade, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') // 1000 - epoch_us(coalesce(last_trade, TIMESTAMP '2024-01-01 00:00:00')) // 1000) / 1000.0::DOUBLE AS age_seconds FROM (SELECT unnest(['click', 'view', 'nobody']) AS symbol) s LEFT JOIN l ON s.symbol = l.symbol""",
)
def symbol_age(spark, d):
    return M.symbol_age(trades(spark, d), ntz("2024-02-01"), ["click", "view", "nobody"], ntz("2024-01-01"))


@register("ingestion_rates", f"WITH {FAULTY} SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, count(*) AS messages, count(*) / 300::DOUBLE AS rate, count(*) FILTER (price IS NULL OR price <= 0) / count(*)::DOUBLE AS error_ratio FROM faulty WHERE event_time IS NOT NULL GROUP BY 1")
def ingestion_rates(spark, d):
    return M.rates(faulty(spark, d))


METRICS = f"""{FAULTY}, w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start FROM faulty WHERE event_time IS NOT NULL),
  m AS (SELECT 'kafka_lag' AS metric, 'all' AS key, window_start, (max(event_id) - min(event_id))::DOUBLE AS value FROM w GROUP BY window_start
    UNION ALL SELECT 'dead_letters', 'all', window_start, count(*) FILTER (price IS NULL OR price <= 0)::DOUBLE FROM w GROUP BY window_start
    UNION ALL SELECT 'consumer_error_ratio', 'all', window_start, count(*) FILTER (price IS NULL OR price <= 0) / count(*)::DOUBLE FROM w GROUP BY window_start
    UNION ALL SELECT 'symbol_age_seconds', symbol, window_start, epoch(window_start + INTERVAL 5 MINUTE - max(event_time))::DOUBLE FROM w GROUP BY symbol, window_start),
  a AS (SELECT * FROM (VALUES ('kafka_lag', 1000.0::DOUBLE, 2), ('dead_letters', 0.0::DOUBLE, 1), ('symbol_age_seconds', 120.0::DOUBLE, 1), ('consumer_error_ratio', 0.05::DOUBLE, 1)) AS t(metric, "limit", windows)),
  o AS (SELECT m.*, "limit", windows FROM m JOIN a USING (metric) WHERE value > "limit")"""


def metrics(spark, d):
    """Metric rows every five minutes: the spread of ids stands for the lag."""
    t = faulty(spark, d).where("event_time is not null").withColumn("window_start", F.window("event_time", "5 minutes").start)
    bad = F.count_if(F.col("price").isNull() | (F.col("price") <= 0))
    g = t.groupBy("window_start").agg((F.max("event_id") - F.min("event_id")).cast("double").alias("kafka_lag"), bad.cast("double").alias("dead_letters"), (bad / F.count("*")).alias("consumer_error_ratio"))
    wide = g.unpivot(["window_start"], ["kafka_lag", "dead_letters", "consumer_error_ratio"], "metric", "value").withColumn("key", F.lit("all"))
    age = t.groupBy("symbol", "window_start").agg(F.max("event_time").alias("_last"))
    seconds = (F.unix_micros((F.col("window_start") + F.expr("interval 5 minutes")).cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp"))) / 1_000_000
    return wide.unionByName(age.select("window_start", F.lit("symbol_age_seconds").alias("metric"), seconds.alias("value"), F.col("symbol").alias("key")))


@register(
    "pipeline_alerts",
    f"""WITH {METRICS} SELECT metric, key, window_start, value, "limit" FROM o WHERE windows = 1 OR EXISTS (SELECT 1 FROM o AS b WHERE b.metric = o.metric AND b.key = o.key AND b.window_start = o.window_start - INTERVAL 5 MINUTE)""",
)
def pipeline_alerts(spark, d):
    return M.firing_alerts(metrics(spark, d))


@register("cache_hit_ratio", "SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, count(*) AS requests, count(*) FILTER (event_id % 3 = 0) / count(*)::DOUBLE AS hit_ratio FROM events GROUP BY 1")
def cache_hit_ratio(spark, d):
    return M.slo_rollup(requests(spark, d), "10 minutes").select("window_start", "requests", "hit_ratio")


@register(
    "readiness_with_publication",
    f"""WITH {GRID}, {BARS}, l AS (SELECT symbol, max(window_end) AS cutoff, arg_max(close, window_end) AS offline_close FROM bars GROUP BY symbol),
m AS (SELECT symbol, count(*) AS missing_bars FROM grid ANTI JOIN bars USING (symbol, window_start) GROUP BY symbol)
SELECT l.symbol, cutoff >= TIMESTAMP '2024-01-30 21:00:00' AS ready, coalesce(missing_bars, 0) AS missing_bars, 'r1' AS dataset_id, cutoff >= TIMESTAMP '2024-01-30 21:00:00' AND coalesce(missing_bars, 0) = 0 AS operational FROM l LEFT JOIN m ON l.symbol = m.symbol""",
)
def readiness_with_publication(spark, d):
    b = labelled(spark, d)
    ready = M.readiness(P.latest_per_key(b, ["close"]), b, ntz("2024-01-30 21:00:00"))
    missing = V.missing_bars(half_hours(spark, d), sess(spark, d), SYMBOLS)
    published = R.latest_publication(b.agg(F.max("event_timestamp").alias("max_event_time")).select(F.lit("r1").alias("dataset_id"), F.lit("complete").alias("status"), F.lit("{}").alias("manifest"), "max_event_time", F.col("max_event_time").alias("updated_at")))
    return M.operations_readiness(ready, missing, published.select("dataset_id")).select("symbol", "ready", "missing_bars", "dataset_id", "operational")


# Quality


@register("missing_symbols", "SELECT s AS symbol FROM (SELECT unnest(['CLICK', 'VIEW', 'NOBODY']) AS s) WHERE s NOT IN (SELECT upper(event_type) FROM events)")
def missing_symbols(spark, d):
    return Q.missing_symbols(trades(spark, d), ["click", "View ", "nobody"])


@register("frame_symbol_set", f"WITH {BARS} SELECT 'NOBODY' AS symbol, 'missing' AS problem UNION ALL SELECT DISTINCT upper(symbol), 'unexpected' FROM bars WHERE symbol NOT IN ('click', 'view')")
def frame_symbol_set(spark, d):
    return Q.symbol_set(half_hours(spark, d).withColumn("symbol", F.upper("symbol")), ["CLICK", "VIEW", "NOBODY"])


@register(
    "feature_validation",
    f"""WITH {GAPPY}, u AS (SELECT symbol, window_start, close, open AS v FROM gappy UNION ALL SELECT symbol, window_start, close, open FROM gappy WHERE symbol = 'view')
SELECT count(*) FILTER (v IS NULL) AS filled, count(*) FILTER (close IS NULL) AS rows_with_null, count(*) FILTER (symbol = 'view') // 2 AS repeated_rows, FALSE AS passed FROM u""",
)
def feature_validation(spark, d):
    g = gappy(spark, d).select("symbol", "window_start", "close", F.col("open").alias("rolling_volatility_close"))
    return Q.validate_features(g.unionByName(g.where("symbol = 'view'")), ["symbol", "window_start", "close"])[1]


@register("late_dropped", f"WITH {FAULTY} SELECT event_id, symbol FROM faulty WHERE trim(symbol) <> '' AND price > 0 AND volume >= 0 AND timestamp IS NOT NULL AND event_time >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 MINUTE")
def late_dropped(spark, d):
    return Q.split(faulty(spark, d), ntz("2024-01-20"), strategy="drop")[0].select("event_id", "symbol")


@register("finite_rows", f"WITH {GAPPY} SELECT symbol, window_start, open, close FROM gappy WHERE open IS NOT NULL AND close IS NOT NULL")
def finite_rows(spark, d):
    return Q.drop_non_finite(gappy(spark, d), ["open", "close"]).select("symbol", "window_start", "open", "close")


# The universe: the brands of the parts as companies


BRANDS = """br AS (SELECT upper(replace(p_brand, '#', '-')) AS symbol, min(p_name) AS company_name, min(p_type) AS sector FROM part GROUP BY 1)"""


def brands(spark, d):
    p = read(spark, d, "part").groupBy(F.upper(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("symbol"))
    return p.agg(F.min("p_name").alias("company_name"), F.min("p_type").alias("sector"))


LINES = f"""{BRANDS}, ln AS (SELECT 'companies.csv' AS artifact, symbol, '"' || symbol || '","' || replace(company_name, '"', '""') || '","' || sector || '"' AS line FROM br
  UNION ALL SELECT 'companies.json', symbol, '{{"symbol":"' || symbol || '","company_name":"' || company_name || '","sector":"' || sector || '"}}' FROM br UNION ALL SELECT 'symbols.txt', symbol, symbol FROM br),
  art AS (SELECT artifact, count(*) AS members, string_agg(line, chr(10) ORDER BY symbol) || chr(10) AS body FROM ln GROUP BY artifact)"""


@register("universe_artifacts", f"WITH {LINES} SELECT artifact, members, strlen(body) AS bytes, sha256(body) AS sha256 FROM art")
def universe_artifacts(spark, d):
    return U.artifacts(brands(spark, d))


@register("universe_governed", f"WITH {BRANDS} SELECT symbol, '' AS refused FROM br UNION ALL SELECT 'after 40 hours', 'stale' UNION ALL SELECT 'with a line more', 'size,checksum,count,symbols'")
def universe_governed(spark, d):
    """The universe written, read by its pointer and checked: as it is, too late, and changed."""
    folder = workspace(spark, "universe")
    U.export(brands(spark, d), folder, "run", ntz("2024-01-20"))
    pointer, lines = spark.read.json(f"{folder}/current"), spark.read.text(f"{folder}/run/symbols.txt")
    good = U.governed(spark, folder, ntz("2024-01-20 12:00:00")).withColumn("refused", F.lit(""))
    late = U.governed_checks(pointer, lines, ntz("2024-01-21 16:00:00")).select(F.lit("after 40 hours").alias("symbol"), F.array_join("refused", ",").alias("refused"))
    changed = U.governed_checks(pointer, lines.unionByName(lines.limit(1).select(F.lit("ZZ").alias("value"))), ntz("2024-01-20 12:00:00")).select(F.lit("with a line more").alias("symbol"), F.array_join("refused", ",").alias("refused"))
    return good.unionByName(late).unionByName(changed)


@register(
    "universe_refresh",
    f"""WITH {BRANDS}, p AS (SELECT symbol FROM br WHERE right(symbol, 1) <> '1') SELECT (SELECT count(*) FROM br) AS members, (SELECT count(*) FROM br WHERE symbol NOT IN (FROM p)) AS added, 0::BIGINT AS removed,
  (SELECT count(*) FROM br WHERE symbol NOT IN (FROM p))::DOUBLE / (SELECT count(*) FROM p) AS churn, FALSE AS published""",
)
def universe_refresh(spark, d):
    b = brands(spark, d)
    return jobs.universe_refresh(b.where(F.right("symbol", F.lit(1)) != "1"), b, workspace(spark, "refresh"), "run", ntz("2024-01-20"), least=1)


# Point in time, training and evaluation


@register(
    "entity_pairs",
    f"""WITH {BARS}, q AS (SELECT * FROM (VALUES ('click', TIMESTAMP '2024-01-10 12:10:00'), ('view', TIMESTAMP '2024-01-15 00:00:00'), ('view', TIMESTAMP '2023-01-15 00:00:00'), ('nobody', TIMESTAMP '2024-01-10 12:10:00')) AS t(symbol, event_timestamp))
SELECT q.symbol, event_timestamp, (SELECT arg_max(close, window_end) FROM bars b WHERE b.symbol = q.symbol AND window_end <= event_timestamp AND window_end >= event_timestamp - INTERVAL 2 HOUR) AS close FROM q""",
)
def entity_pairs(spark, d):
    pairs = P.paired_spine(spark, ["click", "view", "view", "nobody"], ["2024-01-10 12:10:00", "2024-01-15 00:00:00", "2023-01-15 00:00:00", "2024-01-10 12:10:00"])
    return P.asof(pairs, labelled(spark, d), ["close"], "2 hours").select("symbol", "event_timestamp", "close")


@register(
    "online_incremental",
    f"""WITH {BARS}, first AS (SELECT symbol, window_end AS event_timestamp, close FROM bars WHERE window_end <= TIMESTAMP '2024-01-10 00:00:00'), later AS (SELECT symbol, window_end AS event_timestamp, close FROM bars WHERE window_end > TIMESTAMP '2024-01-20 00:00:00' AND window_end <= TIMESTAMP '2024-01-25 00:00:00')
SELECT symbol, max(event_timestamp) AS event_timestamp, arg_max(close, event_timestamp) AS close FROM (FROM first UNION ALL FROM later) GROUP BY symbol""",
)
def online_incremental(spark, d):
    b = labelled(spark, d)
    online = P.latest_per_key(b.where(F.col("event_timestamp") <= ntz("2024-01-10")), ["close"])
    return P.materialise_since(online, b, ntz("2024-01-25"), ["close"], 5)


@register("groups_without_windows", f"WITH {INDEX} SELECT DISTINCT symbol FROM rows WHERE symbol NOT IN (SELECT symbol FROM idx WHERE symbol <> 'error')")
def groups_without_windows(spark, d):
    return TR.groups_without_windows(labelled(spark, d), index(spark, d).where("symbol <> 'error'"))


@register(
    "training_dataset",
    f"""WITH {INDEX} SELECT i.symbol, count(*) AS windows, count(*) FILTER (in_holdout) AS holdout_windows, any_value(train_rows) AS train_rows, any_value(training_last_idx) AS training_last_idx, (SELECT cutoff FROM cut) AS cutoff FROM idx i JOIN bound USING (symbol) GROUP BY i.symbol""",
)
def training_dataset(spark, d):
    rows = labelled(spark, d).select("symbol", "event_timestamp", "close")
    found = jobs.training_dataset(rows, ["close"], ratio=0.2, encoder=96, horizon=13, every_group=False)
    return found.windows.groupBy("symbol").agg(F.count("*").alias("windows"), F.count_if("in_holdout").alias("holdout_windows")).join(found.boundaries.select("symbol", "train_rows", "training_last_idx"), "symbol").crossJoin(F.broadcast(found.cutoff))


@register("calibration_error", f"WITH {SAMPLES}, s AS (SELECT horizon, quantile, avg((y_true <= y_pred)::INT) AS o FROM fc GROUP BY ALL) SELECT quantile, round(avg(abs(o - quantile)), 8) AS calibration_error FROM s GROUP BY quantile")
def calibration_error(spark, d):
    return rounded(E.calibration_error(forecasts(spark, d)), "calibration_error")


@register("returns_to_prices", f"WITH {SAMPLES}, v AS (SELECT DISTINCT sample_id, horizon, y_true FROM fc) SELECT sample_id, horizon, round(100 * exp(sum(y_true) OVER (PARTITION BY sample_id ORDER BY horizon)), 8) AS price FROM v")
def returns_to_prices(spark, d):
    v = forecasts(spark, d).where("quantile = 0.5").select("sample_id", "horizon", F.col("y_true").alias("value"), F.lit(100.0).alias("base_price"))
    return rounded(E.returns_to_prices(v), "price").select("sample_id", "horizon", "price")


@register("unequal_universes", f"WITH {TRADES} SELECT 'view' AS symbol, 'reference' AS only_in WHERE EXISTS (SELECT 1 FROM trades WHERE symbol = 'view') UNION ALL SELECT 'error', 'current' WHERE EXISTS (SELECT 1 FROM trades WHERE symbol = 'error')")
def unequal_universes(spark, d):
    t = trades(spark, d)
    return D.unequal_universes(t.where("symbol <> 'error'"), t.where("symbol <> 'view'"))


@register("drift_periods", f"WITH {BARS} SELECT CASE WHEN window_end < TIMESTAMP '2024-01-21 00:00:00' THEN 'reference' ELSE 'current' END AS period, symbol, count(*) AS n FROM bars WHERE window_end >= TIMESTAMP '2024-01-11 00:00:00' GROUP BY ALL")
def drift_periods(spark, d):
    old, new = D.periods(labelled(spark, d), ntz("2024-01-31"), 20, 10)
    return old.withColumn("period", F.lit("reference")).unionByName(new.withColumn("period", F.lit("current"))).groupBy("period", "symbol").agg(F.count("*").alias("n"))


# Publication


@register("month_partitions", "WITH s AS (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate))::TIMESTAMP, date_trunc('month', max(o_orderdate))::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM orders) SELECT strftime(m, '%Y-%m') AS \"partition\", m::DATE AS since, (m + INTERVAL 1 MONTH)::DATE AS until FROM s")
def month_partitions(spark, d):
    return R.month_partitions(read(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")))


#: One manifest a day; every sixth has its times out of order, every eighth closes too early, one day is listed twice.
MANIFESTS = """mf AS (SELECT 'r' || strftime(ts, '%Y%m%d') AS dataset_id, CASE WHEN day(any_value(ts)) % 6 = 0 THEN max(ts) ELSE min(ts) END AS min_event_time, CASE WHEN day(any_value(ts)) % 6 = 0 THEN min(ts) ELSE max(ts) END AS max_event_time,
  any_value(ts)::DATE + CASE WHEN day(any_value(ts)) % 8 = 0 THEN INTERVAL 1 MINUTE ELSE INTERVAL 1439 MINUTE + INTERVAL 59 SECOND + INTERVAL 999999 MICROSECOND END AS market_close, count(*) AS row_count, any_value(ts)::DATE + INTERVAL 2 DAY AS completed_at FROM events GROUP BY 1),
  mm AS (FROM mf UNION ALL SELECT * REPLACE (row_count + 1 AS row_count, completed_at + INTERVAL 1 HOUR AS completed_at) FROM mf WHERE dataset_id = 'r20240119')"""


def manifests(spark, d):
    t = trades(spark, d).withColumn("day", F.to_date("event_time"))
    g = t.groupBy("day").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count("*").alias("row_count"))
    sixth, eighth = F.dayofmonth("day") % 6 == 0, F.dayofmonth("day") % 8 == 0
    close = F.col("day").cast("timestamp_ntz") + F.when(eighth, F.expr("interval 1 minute")).otherwise(F.expr("interval 23 hours 59 minutes 59.999999 seconds"))
    m = g.select(
        F.concat(F.lit("r"), F.date_format("day", "yyyyMMdd")).alias("dataset_id"), F.when(sixth, F.col("b")).otherwise(F.col("a")).alias("min_event_time"), F.when(sixth, F.col("a")).otherwise(F.col("b")).alias("max_event_time"),
        close.alias("market_close"), "row_count", F.date_add("day", 2).cast("timestamp_ntz").alias("completed_at"),
    )
    again = m.where("dataset_id = 'r20240119'").withColumns({"row_count": F.col("row_count") + 1, "completed_at": F.col("completed_at") + F.expr("interval 1 hour")})
    return m.unionByName(again)


@register(
    "manifest_problems",
    f"""WITH {MANIFESTS} SELECT DISTINCT dataset_id, unnest(list_filter([CASE WHEN min_event_time > max_event_time THEN 'times_out_of_order' END, CASE WHEN max_event_time > market_close THEN 'rows_after_the_close' END], lambda x: x IS NOT NULL)) AS problem FROM mm
UNION ALL SELECT 'r20240119', 'id_reused' WHERE (SELECT count(*) FROM mm WHERE dataset_id = 'r20240119') > 1""",
)
def manifest_problems(spark, d):
    return R.manifest_problems(manifests(spark, d))


@register("session_manifests", f"""WITH {MANIFESTS} SELECT dataset_id, completed_at, row_number() OVER (ORDER BY completed_at DESC)::INTEGER AS "order" FROM mm WHERE ((market_close AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE = DATE '2024-01-19'""")
def session_manifests(spark, d):
    return R.of_session(manifests(spark, d), F.lit("2024-01-19").cast("date")).select("dataset_id", "completed_at", "order")


#: Releases by day: some pending, some of an unknown policy, some not passed, some historical and adjusted.
PUBLISHED = f"""{BARS}, ver AS (SELECT symbol, window_start, close, 'r' || strftime(window_start, '%Y%m%d') AS dataset_version, day(window_start) AS dd FROM bars),
  fit AS (SELECT * FROM ver WHERE dd % 7 <> 0 AND dd % 11 <> 0 AND dd % 13 <> 0 AND NOT (dd % 5 = 0 AND dd % 2 = 0))"""


def book(spark, d):
    """A ledger with a release a day."""
    day = F.dayofmonth("d")
    days = trades(spark, d).select(F.to_date("event_time").alias("d")).distinct()
    session = F.struct(F.when(day % 11 == 0, "unknown").when(day % 2 == 0, R.POLICIES[0]).otherwise(R.POLICIES[1]).alias("policy"), F.when(day % 13 == 0, "failed").otherwise("passed").alias("status"))
    source = F.when(day % 5 == 0, F.struct(F.when(day % 2 == 0, "split").otherwise("unadjusted").alias("adjustment")))
    return days.select(F.concat(F.lit("r"), F.date_format("d", "yyyyMMdd")).alias("dataset_id"), F.when(day % 7 == 0, "pending").otherwise("complete").alias("status"), F.to_json(F.struct(session.alias("session_qualification"), source.alias("historical_source"))).alias("manifest"))


@register("ledger_rows", f"WITH {PUBLISHED}, l AS (SELECT * FROM fit WHERE hour(window_start) < 16), h AS (SELECT * REPLACE (close + 1 AS close) FROM fit WHERE hour(window_start) >= 12) SELECT symbol, window_start, close FROM l UNION ALL SELECT symbol, window_start, close FROM h ANTI JOIN l USING (symbol, window_start)")
def ledger_rows(spark, d):
    rows = versioned(spark, d).join(half_hours(spark, d).select("symbol", "window_start", F.col("window_end").alias("event_timestamp")), ["symbol", "event_timestamp"])
    late = rows.where(F.hour("window_start") >= 12).withColumn("close", F.col("close") + 1)
    return R.ledger_rows(rows.where(F.hour("window_start") < 16), late, book(spark, d)).select("symbol", "window_start", "close")


@register("historical_publication", f"WITH {BARS} SELECT symbol, window_start, close, total_volume FROM bars WHERE window_start >= TIMESTAMP '2024-01-20 00:00:00'")
def historical_publication(spark, d):
    """What a history adds to one that holds its first weeks."""
    b = half_hours(spark, d).select("symbol", "window_start", "close", "total_volume")
    return releases.history_rows(b.where(F.col("window_start") < ntz("2024-01-20")), b, ["close", "total_volume"])


@register(
    "publication",
    f"""WITH {BARS}, a AS (SELECT * FROM bars WHERE window_end <= TIMESTAMP '2024-01-20 00:00:00'), b AS (SELECT * REPLACE (close + 1 AS close) FROM bars WHERE window_end > TIMESTAMP '2024-01-18 00:00:00' AND window_end <= TIMESTAMP '2024-01-25 00:00:00'),
o AS (SELECT 'b' AS release, symbol, close, window_end FROM b UNION ALL SELECT 'a', symbol, close, window_end FROM a ANTI JOIN b USING (symbol, window_start))
SELECT 'offline ' || release AS what, symbol, count(*) AS n, round(sum(close), 6) AS closes FROM o GROUP BY ALL UNION ALL SELECT 'online', symbol, 1, round(arg_max(close, window_end), 6) FROM o GROUP BY symbol
UNION ALL SELECT 'refused ' || r, NULL, 1, NULL FROM (SELECT unnest(['older', 'reused', 'short']) AS r)""",
)
def publication(spark, d):
    """Two releases that overlap, and three that are refused: an older one, an id that is used again, rows that are missing."""
    w = workspace(spark, "publication")
    rows = half_hours(spark, d).select("symbol", "window_start", F.col("window_end").alias("event_timestamp"), "close")

    def made(name, dataset_id, part):
        part.write.parquet(f"{w}/{name}/features")
        releases.write_manifest(spark, f"{w}/{name}", dataset_id, historical=False)
        return f"{w}/{name}"

    end = F.col("event_timestamp")
    first = made("a", "a", rows.where(end <= ntz("2024-01-20")))
    second = made("b", "b", rows.where((end > ntz("2024-01-18")) & (end <= ntz("2024-01-25"))).withColumn("close", F.col("close") + 1))
    schema = rows.withColumns({"dataset_version": F.lit(""), "created_at": F.current_timestamp()}).schema
    offline, book = tables.VersionedTable(spark, f"{w}/offline", schema).create_if_missing(), tables.Ledger(spark, f"{w}/ledger", releases.LEDGER)
    view = spark.createDataFrame([], "symbol string, event_timestamp timestamp_ntz, close double")
    for release in (first, second):
        releases.publish(release, offline, book, view, write_online=lambda v, name=release: v.write.parquet(f"{name}/online"))
        view = spark.read.parquet(f"{release}/online")
    short = made("short", "c", rows.where(end > ntz("2024-01-25")))
    rows.limit(1).write.mode("append").parquet(f"{short}/features")
    refused = []
    for name, release in (("older", made("older", "d", rows.where(end <= ntz("2024-01-10")))), ("reused", made("reused", "a", rows.where(end <= ntz("2024-01-26")))), ("short", short)):
        try:
            releases.publish(release, offline, book, view)
        except releases.Refused:
            refused.append((f"refused {name}", None, 1, None))
    held = offline.read().where("created_at is not null").groupBy(F.concat(F.lit("offline "), "dataset_version").alias("what"), "symbol").agg(F.count("*").alias("n"), F.round(F.sum("close"), 6).alias("closes"))
    shown = view.select(F.lit("online").alias("what"), "symbol", F.lit(1).cast("long").alias("n"), F.round("close", 6).alias("closes"))
    return held.unionByName(shown).unionByName(spark.createDataFrame(refused, "what string, symbol string, n long, closes double"))


@register(
    "history_checks",
    f"""WITH {GRID}, {BARS}, f AS (SELECT symbol, window_start, CASE WHEN symbol = 'click' AND hour(window_start) = 3 THEN NULL ELSE total_volume END AS total_volume FROM bars WHERE symbol <> 'signup' UNION ALL SELECT symbol, window_start, total_volume FROM bars WHERE symbol = 'view' AND day(window_start) % 9 = 0),
k AS (SELECT symbol, window_start, count(*) AS n FROM f GROUP BY ALL), c AS (SELECT count(*) FILTER (k.symbol IS NULL) AS missing_keys, count(*) FILTER (g.symbol IS NULL) AS off_session_keys FROM k FULL JOIN grid g ON k.symbol = g.symbol AND k.window_start = g.window_start)
SELECT unnest(['missing_keys', 'off_session_keys', 'repeated_keys', 'volume_not_bigint', 'symbol_set', 'unfinished_sessions', 'no_sessions', 'retrieved_ahead', 'checksum']) AS "check",
  unnest([missing_keys, off_session_keys, (SELECT sum(n - 1)::BIGINT FROM k), (SELECT count(*) FROM f WHERE total_volume IS NULL), (SELECT count(*) FROM (SELECT DISTINCT symbol FROM bars ANTI JOIN f USING (symbol))), (SELECT count(*) FROM sess WHERE market_close > TIMESTAMP '2024-01-20 00:01:00'), 0, 1, 1]) AS violations FROM c""",
)
def history_checks(spark, d):
    """A history with faults: a symbol is missing, some bars are there twice, some volumes are null, it was retrieved ahead of the
    clock, and its digest is another's."""
    b = half_hours(spark, d).where(F.col("symbol") != "signup")
    twice = b.where((F.col("symbol") == "view") & (F.dayofmonth("window_start") % 9 == 0))
    odd = b.withColumn("total_volume", F.when(~((F.col("symbol") == "click") & (F.hour("window_start") == 3)), F.col("total_volume")))
    return V.history_checks(odd.unionByName(twice), sess(spark, d), SYMBOLS, "another", ntz("2024-01-20 00:10:00"), ntz("2024-01-20 00:01:00"))


# Composed jobs


@register("session_report", f"""WITH {GRID}, {BARS}, i AS (SELECT symbol, count(*) AS n FROM trades, sess WHERE session_date = DATE '2024-01-19' AND event_time >= market_open AND event_time < market_close GROUP BY symbol),
m AS (SELECT symbol, count(*) AS missing FROM grid ANTI JOIN bars USING (symbol, window_start) WHERE session_date = DATE '2024-01-19' GROUP BY symbol),
g AS (SELECT symbol, timestamp AS ms FROM trades, sess WHERE session_date = DATE '2024-01-19' AND event_time >= market_open AND event_time < market_close UNION ALL SELECT s, epoch_us(market_open) // 1000 FROM sess, (SELECT unnest(['click', 'purchase', 'signup', 'view', 'error']) AS s) WHERE session_date = DATE '2024-01-19' UNION ALL SELECT s, epoch_us(market_close) // 1000 FROM sess, (SELECT unnest(['click', 'purchase', 'signup', 'view', 'error']) AS s) WHERE session_date = DATE '2024-01-19'),
w AS (SELECT symbol, count(*) FILTER (gap > 120000) AS gaps FROM (SELECT symbol, ms - lag(ms) OVER (PARTITION BY symbol ORDER BY ms) AS gap FROM g) GROUP BY symbol)
SELECT w.symbol, coalesce(n, 0) AS trades, gaps AS gaps_over_limit, coalesce(missing, 0) AS missing_bars, FALSE AS qualified FROM w LEFT JOIN i ON w.symbol = i.symbol LEFT JOIN m ON w.symbol = m.symbol""")
def session_report(spark, d):
    day = sess(spark, d).where(F.col("session_date") == F.lit("2024-01-19").cast("date"))
    return jobs.session_report(trades(spark, d), half_hours(spark, d), day, SYMBOLS)


@register("batch_features", f"WITH {BARS}, f AS (SELECT symbol, window_start, close, round(avg(close) OVER w, 8) AS rolling_avg_close, round(stddev_samp(close) OVER w, 8) AS rolling_volatility_close FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND CURRENT ROW)) SELECT * FROM f WHERE rolling_volatility_close IS NOT NULL")
def batch_features(spark, d):
    """The feature job: bars from a folder, features to another, read back."""
    path = workspace(spark, "features")
    half_hours(spark, d).write.parquet(f"{path}/bars")
    jobs.batch_features(spark, f"{path}/bars", f"{path}/features")
    return rounded(spark.read.parquet(f"{path}/features"), "rolling_avg_close", "rolling_volatility_close").select("symbol", "window_start", "close", "rolling_avg_close", "rolling_volatility_close")


@register("incremental_load", f"WITH {BARS} SELECT symbol, count(*) AS n, round(sum(close), 6) AS closes, max(window_start) AS newest FROM bars GROUP BY symbol")
def incremental_load(spark, d):
    """Two loads, the second of which holds rows that the first has loaded; each only adds what is newer."""
    path = workspace(spark, "load")
    b = half_hours(spark, d)
    jobs.incremental_load(b.where(F.col("window_start") < ntz("2024-01-20")), f"{path}/offline")
    jobs.incremental_load(b, f"{path}/offline")
    t = jobs.offline_table(spark, f"{path}/offline", b).read()
    return rounded(t.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("close").alias("closes"), F.max("window_start").alias("newest")), "closes", digits=6)


BAD = "(event_id % 83 = 0 OR event_id % 97 = 0 OR price IS NULL OR price <= 0 OR volume IS NULL OR volume < 0)"


@register(
    "live_session",
    f"WITH {TRADES} SELECT 'bronze' AS output, count(*) AS n FROM trades WHERE NOT {BAD} UNION ALL SELECT 'dead', count(*) FROM trades WHERE {BAD} UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT symbol, time_bucket(INTERVAL 30 MINUTE, event_time) FROM trades WHERE NOT {BAD})",
)
def live_session(spark, d):
    """The live job over the events until they are used up: what each of its three queries has written."""
    job = jobs.live_session(faulty_stream(spark, d), workspace(spark, "live"), ntz("2023-01-01").cast("timestamp"), {"availableNow": True})
    live.watch(job.queries)
    job.close()
    parts = [spark.read.parquet(job.bronze), spark.read.parquet(job.dead), job.gold.read()]
    rows = [p.agg(F.count("*").alias("n")).withColumn("output", F.lit(name)) for p, name in zip(parts, ("bronze", "dead", "gold"), strict=True)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register(
    "live_metrics",
    f"""WITH {TRADES}, t AS (SELECT event_id % 83 = 0 AS s, event_id % 97 = 0 OR price IS NULL OR price <= 0 AS p, volume IS NULL OR volume < 0 AS v, event_time < TIMESTAMP '2024-01-03 23:55:00' AS l FROM trades)
SELECT 'trades' AS name, m.metric, m.n FROM (SELECT unnest([{{'metric': 'rows', 'n': count(*)}}, {{'metric': 'rejected', 'n': count(*) FILTER (s OR p OR v OR l)}}, {{'metric': 'missing_symbol', 'n': count(*) FILTER (s)}}, {{'metric': 'invalid_price', 'n': count(*) FILTER (p)}}, {{'metric': 'invalid_volume', 'n': count(*) FILTER (v)}}, {{'metric': 'late_event', 'n': count(*) FILTER (l)}}]) AS m FROM t) WHERE m.n > 0
UNION ALL SELECT 'trades', 'input_rows', count(*) FROM events""",
)
def live_metrics(spark, d):
    """What the live job's listener has kept: rows, and rejections by reason, summed over its batches."""
    job = jobs.live_session(faulty_stream(spark, d), workspace(spark, "live-metrics"), ntz("2024-01-04").cast("timestamp"), {"availableNow": True})
    live.watch(job.queries)
    job.close()
    rows = job.metrics.read().where("name = 'trades'")
    each = rows.select("name", F.explode(F.map_concat("observed", F.create_map(F.lit("input_rows"), "input_rows"))).alias("metric", "n"))
    return each.groupBy("name", "metric").agg(F.sum("n").alias("n")).where("n > 0")


@register("stream_partition_lag", "SELECT 'seen' AS name, count(*) AS input_rows, 0::BIGINT AS lag, TRUE AS timed FROM events")
def stream_partition_lag(spark, d):
    """Progress with rates, and the lag as the sum over partitions of what the source holds beyond the batch's end."""
    w = workspace(spark, "stream-rates")
    q = live.append(stream_of(spark, d), f"{w}/trades", f"{w}/checkpoint", {"availableNow": True}, "seen")
    q.awaitTermination()
    rows = spark.createDataFrame([live.progress_metrics(p) for p in q.recentProgress], live.PROGRESS)
    return rows.groupBy("name").agg(F.sum("input_rows").alias("input_rows"), F.max("lag").alias("lag"), F.min((F.col("batch_ms") >= 0) & (F.col("processed_per_second") >= 0)).alias("timed"))
