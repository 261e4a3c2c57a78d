"""Data quality: tagging, splitting and counting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LATE = "5 minutes"


def trade_rules(as_of: Column | None = None, late: str | None = LATE, strategy: str = "dead_letter", finite: bool = False) -> dict[str, Column]:
    """Reason to condition. Volume 0 is valid here. ``finite`` adds a rule for NaN and infinities."""
    c = F.col
    # fixed values: the reasons and their order
    rules = {
        "missing_symbol": c("symbol").isNull() | (F.trim("symbol") == ""),
        "invalid_price": c("price").isNull() | (c("price") <= 0),
        "invalid_volume": c("volume").isNull() | (c("volume") < 0),
        "invalid_timestamp": c("timestamp").isNull() | (c("timestamp") <= 0),
        "invalid_event_time": c("event_time").isNull(),
    }
    if finite:
        rules["non_finite"] = F.isnan("price") | F.isnan("volume") | (F.abs("price") == float("inf")) | (F.abs("volume") == float("inf"))
    if late and strategy == "dead_letter":
        rules["late_event"] = is_late(as_of, late)
    return rules


def is_late(as_of: Column | None = None, late: str = LATE) -> Column:
    return F.col("event_time") < (F.current_timestamp() if as_of is None else as_of) - F.expr(f"interval {late}")


def tag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds dq_reason: all reasons that hold, joined by semicolons; null for a valid row. A condition that is null doesn't hold."""
    reasons = F.concat_ws(";", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumn("dq_reason", F.nullif(reasons, F.lit("")))


def observed(tagged: DataFrame, rules: Sequence[str], name: str = "quality") -> DataFrame:
    """``tagged`` as it is, with counts that are taken while it runs: its rows, the rejected ones, and those of each reason."""
    has = [F.count_if(F.array_contains(F.split("dq_reason", ";"), r)).alias(r) for r in rules]
    return tagged.observe(name, F.count(F.lit(1)).alias("rows"), F.count("dq_reason").alias("rejected"), *has)


def split(df: DataFrame, as_of: Column | None = None, late: str | None = LATE, strategy: str = "dead_letter") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with dq_reason and ingested_at; both read the same tags, so no row is in both or neither."""
    tagged = tag(df, trade_rules(as_of, late, strategy))
    valid = tagged.where("dq_reason is null").drop("dq_reason")
    if late and strategy == "drop":
        valid = valid.where(~F.coalesce(is_late(as_of, late), F.lit(False)))
    stamp = F.current_timestamp() if as_of is None else as_of
    return valid, tagged.where("dq_reason is not null").withColumn("ingested_at", stamp)


def reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("dq_reason").agg(F.count("*").alias("n"))


def strict_trades(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """``df`` with valid: listed symbol, finite positive price and volume, a timestamp of 13 digits."""
    ok = F.col("symbol").isin(list(symbols)) & (F.col("price") > 0) & (F.abs("price") < float("inf")) & (F.col("volume") > 0) & (F.abs(F.col("volume").cast("double")) < float("inf"))
    ok = ok & (F.col("timestamp") >= 10**12) & (F.col("timestamp") < 10**14)
    return df.withColumn("valid", F.coalesce(ok, F.lit(False)))


def allow_symbols(df: DataFrame, symbols: Sequence[str], col: str = "symbol") -> DataFrame:
    """Normalised symbols on the list only."""
    clean = F.upper(F.trim(col))
    return df.withColumn(col, clean).where(F.col(col).isin([s.strip().upper() for s in symbols]))


def duplicate_payloads(trades: DataFrame) -> DataFrame:
    """How many trades repeat another one's payload; they are counted, never dropped."""
    same = trades.groupBy("symbol", "timestamp", "price", "volume").agg(F.count("*").alias("n"))
    return same.groupBy("symbol").agg(F.sum("n").alias("trades"), F.sum(F.col("n") - 1).alias("identical"))


TYPE_CLASSES = {"datetime": ("timestamp", "timestamp_ntz", "date"), "float": ("double", "float"), "int": ("bigint", "int", "smallint", "tinyint"), "bool": ("boolean",), "string": ("string",)}


def contract_violations(df: DataFrame, required: dict[str, str], allow_extra: bool = True) -> list[tuple[str, str]]:
    """(column, violation) pairs from the schema alone."""
    have = dict(df.dtypes)
    out = [(c, "missing") for c in required if c not in have]
    out += [(c, f"expected {kind}, got {have[c]}") for c, kind in required.items() if c in have and have[c] not in TYPE_CLASSES[kind]]
    return out + ([] if allow_extra else [(c, "unexpected") for c in have if c not in required])


def frame_rules() -> dict[str, Column]:
    """Conditions that break a feature row."""
    c = F.col
    needed = ["symbol", "window_start", "window_end", "event_timestamp", "open", "high", "low", "close", "total_volume", "rolling_avg_close", "rolling_volatility_close"]
    numbers = needed[4:]

    def any_of(conditions: Sequence[Column]) -> Column:
        return reduce(Column.__or__, conditions)

    return {
        "null_value": any_of([c(x).isNull() for x in needed]),
        "non_finite": any_of([F.isnan(c(x).cast("double")) | (F.abs(c(x).cast("double")) == float("inf")) for x in numbers]),
        "price_not_positive": any_of([c(x) <= 0 for x in ("open", "high", "low", "close", "rolling_avg_close")]),
        "negative_volume_or_volatility": (c("total_volume") < 0) | (c("rolling_volatility_close") < 0),
        "volume_not_bigint": (c("total_volume") % 1 != 0) | (c("total_volume").cast("double") >= float(2**63)),
        "ohlc_bounds": (c("high") < F.greatest("open", "close", "low")) | (c("low") > F.least("open", "close", "high")),
        "window_order": c("window_start") >= c("window_end"),
        "event_time_not_window_end": c("event_timestamp") != c("window_end"),
    }


def violation_counts(df: DataFrame, rules: dict[str, Column], key: Sequence[str] = ("symbol", "window_start")) -> DataFrame:
    """(rule, violations) in one pass, with the rows beyond the first of each key."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_key"))
    names = [*rules, "duplicate_key"]
    rows = counts.crossJoin(repeated).select(F.inline(F.array(*[F.struct(F.lit(x).alias("rule"), F.col(x).alias("violations")) for x in names])))  # one row each
    return rows


def expectations(df: DataFrame, not_null: Sequence[str], types: dict[str, str]) -> DataFrame:
    """(expectation, failures): columns that exist, hold no nulls and have their type."""
    have = dict(df.dtypes)
    schema = [(f"exists:{c}", int(c not in have)) for c in sorted({*not_null, *types})]
    schema += [(f"type:{c}", int(have.get(c) not in TYPE_CLASSES[t])) for c, t in types.items()]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null if c in have])
    rows = [F.struct(F.lit(name).alias("expectation"), F.lit(n).cast("long").alias("failures")) for name, n in schema]
    rows += [F.struct(F.lit(f"not_null:{c}").alias("expectation"), F.col(c).alias("failures")) for c in not_null if c in have]
    return nulls.select(F.inline(F.array(*rows)))


def outliers(df: DataFrame, col: str, threshold: float = 3.0) -> DataFrame:
    """Rows whose distance from the mean is over ``threshold`` population deviations."""
    stats = df.agg(F.avg(col).alias("_mean"), F.stddev_pop(col).alias("_std"))  # one row
    z = F.try_divide(F.col(col) - F.col("_mean"), F.col("_std"))
    return df.crossJoin(F.broadcast(stats)).withColumn("z", z).drop("_mean", "_std").where(F.abs("z") > threshold)


def drop_non_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")) for c in cols]))


def impute(df: DataFrame, cols: Sequence[str], group: str = "symbol", order: str = "event_time", backfill: str = "symbol", slice_by: str = "month") -> DataFrame:
    """Forward fill in each group, then backward.

    A group is filled in slices of time (``slice_by``: a unit that ``date_trunc`` knows), and one row a slice carries the last
    value that lies before it and the first one after it, so no task sorts a group's whole history. ``backfill``: "symbol"
    stays in the group; "global" lets a leading gap take the next value of the frame sorted by group and order, which may be
    the next group's (found from one row a group)."""
    names = {c: f"_f{i}" for i, c in enumerate(cols)}
    sliced = df.withColumn("_slice", F.date_trunc(slice_by, F.col(order).cast("timestamp")))
    at = F.struct(order)

    def end(c: str, pick) -> Column:
        """The first or last value of a slice that isn't null."""
        return pick(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), at))

    ends = sliced.groupBy(group, "_slice").agg(*[end(c, F.max_by).alias(f"{n}l") for c, n in names.items()], *[end(c, F.min_by).alias(f"{n}r") for c, n in names.items()])
    w = W.partitionBy(group).orderBy("_slice")  # a row a slice
    before, after = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)
    carried = ends.select(F.col(group).alias("_g"), F.col("_slice").alias("_s"), *[F.last(f"{n}l", ignorenulls=True).over(before).alias(f"{n}p") for n in names.values()], *[F.first(f"{n}r", ignorenulls=True).over(after).alias(f"{n}n") for n in names.values()])
    out = sliced.join(carried, F.col(group).eqNullSafe(F.col("_g")) & F.col("_slice").eqNullSafe(F.col("_s")), "left").drop("_g", "_s")
    if backfill == "global":
        firsts = ends.groupBy(group).agg(*[F.min_by(f"{n}r", F.when(F.col(f"{n}r").isNotNull(), F.struct("_slice"))).alias(n) for n in names.values()])
        later = W.orderBy(group).rowsBetween(1, W.unboundedFollowing)  # a row a group
        nexts = firsts.select(F.col(group).alias("_g"), *[F.first(n, ignorenulls=True).over(later).alias(f"{n}g") for n in names.values()])
        out = out.join(nexts, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    own = W.partitionBy(group, "_slice").orderBy(order)
    past, ahead = own, own.rowsBetween(0, W.unboundedFollowing)
    filled = {}
    for c, n in names.items():
        ways = [F.last(c, ignorenulls=True).over(past), F.col(f"{n}p"), F.first(c, ignorenulls=True).over(ahead), F.col(f"{n}n")]
        filled[c] = F.coalesce(*ways, *([F.col(f"{n}g")] if backfill == "global" else []))
    return out.withColumns(filled).select(df.columns)


def imputation_stats(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, nulls_before, nulls_after, fixed_pct, residual_pct)."""

    def nulls(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name), F.col("_n").alias(f"{name}_rows")) for c in cols])))

    both = nulls(before, "nulls_before").join(nulls(after, "nulls_after"), "column")
    fixed = F.when(F.col("nulls_before") == 0, 100.0).otherwise(F.round((F.col("nulls_before") - F.col("nulls_after")) * 100.0 / F.col("nulls_before"), 6))
    return both.select("column", "nulls_before", "nulls_after", fixed.alias("fixed_pct"), F.round(F.try_divide(F.col("nulls_after") * 100.0, F.col("nulls_after_rows")), 6).alias("residual_pct"))


def missing_symbols(df: DataFrame, symbols: Sequence[str], col: str = "symbol") -> DataFrame:
    """The listed symbols that ``df`` doesn't cover."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(s.strip().upper(),) for s in symbols], f"{col} string")
    return wanted.join(df.select(F.upper(F.trim(col)).alias(col)).distinct(), col, "left_anti")


def symbol_set(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """(symbol, problem): listed symbols that the frame lacks, and symbols that it has beyond the list; none if the sets agree."""
    have = df.select("symbol").distinct()
    lacking = missing_symbols(df, symbols).withColumn("problem", F.lit("missing"))
    return lacking.unionByName(have.where(F.col("symbol").isNull() | ~F.col("symbol").isin(list(symbols))).withColumn("problem", F.lit("unexpected")))


def validate_features(df: DataFrame, required: Sequence[str], fill: str = "rolling_volatility_close") -> tuple[DataFrame, DataFrame]:
    """``df`` with 0 for a missing volatility, and one row of counts: filled values, rows with a null, rows beyond the first of
    equal ones; passed if there are none of the last two. A missing column is an error before anything runs."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"required columns are missing: {lacking}")
    filled = df.fillna(0.0, [fill]) if fill in df.columns else df
    empty = reduce(Column.__or__, [F.col(c).isNull() for c in df.columns])
    groups = filled.groupBy(*filled.columns).agg(F.count("*").alias("_n"))
    counts = groups.agg(F.coalesce(F.sum(F.when(empty, F.col("_n")).otherwise(0)), F.lit(0)).alias("rows_with_null"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_rows"))
    fills = df.agg((F.count_if(F.col(fill).isNull()) if fill in df.columns else F.lit(0)).alias("filled"))
    return filled, fills.crossJoin(F.broadcast(counts)).withColumn("passed", (F.col("rows_with_null") == 0) & (F.col("repeated_rows") == 0))  # one row each
