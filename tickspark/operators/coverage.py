"""Proof of coverage: gaps between trades, missing bars, and the qualification of sessions and histories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.operators.calendar import new_york_date, session_grid
from tickspark.sources.tables import workspace

GAP_SECONDS = 120


def in_session(df: DataFrame, sess: DataFrame, time: str) -> DataFrame:
    """The rows inside a session, with its columns. The calendar is small and broadcast; the scan gets its first opening and
    last close."""
    span = sess.agg(F.min("market_open").alias("first"), F.max("market_close").alias("last")).first()  # one row
    first, last = (F.lit(str(x) if x else None).cast("timestamp_ntz") for x in span)
    df = df.where((F.col(time) >= first) & (F.col(time) < last))
    d = df.withColumn("session_date", new_york_date(time)).join(F.broadcast(sess), "session_date")
    return d.where((F.col(time) >= F.col("market_open")) & (F.col(time) < F.col("market_close")))


def _millis(name: str):
    return F.unix_millis(F.col(name).cast("timestamp"))


def bucket_gaps(trades: DataFrame, sess: DataFrame) -> DataFrame:
    """Trades of sessions with the milliseconds since the trade before: in the same half hour by a window of its own, so a
    symbol with many trades is spread; the first trade of a half hour is stitched to the half hour before by ``stitched``."""
    t = in_session(trades, sess, "event_time").withColumn("_ms", _millis("event_time")).withColumn("_bucket", F.floor(F.col("_ms") / 1_800_000))
    bucket = W.partitionBy("session_date", "symbol", "_bucket").orderBy("_ms")
    return t.withColumn("_gap", F.col("_ms") - F.lag("_ms").over(bucket))


def tick_coverage(trades: DataFrame, sess: DataFrame, limit: float = GAP_SECONDS) -> DataFrame:
    """Per session and symbol: trades, first, last, the longest gap in seconds (with those to the opening and the close), passed."""
    bad = F.col("price").isNull() | F.isnan("price") | (F.col("price") <= 0) | F.col("volume").isNull() | (F.col("volume") <= 0)
    parts = bucket_gaps(trades, sess).groupBy("session_date", "symbol", "_bucket", "market_open", "market_close").agg(
        F.count("*").alias("n"), F.min("_ms").alias("first"), F.max("_ms").alias("last"), F.max("_gap").alias("gap"), F.count_if(bad).alias("invalid")
    )
    between = F.col("first") - F.lag("last").over(W.partitionBy("session_date", "symbol").orderBy("_bucket"))
    parts = parts.withColumn("gap", F.greatest("gap", between))
    out = parts.groupBy("session_date", "symbol", "market_open", "market_close").agg(
        F.sum("n").alias("trades"), F.min("first").alias("first_ms"), F.max("last").alias("last_ms"), F.max("gap").alias("_inner"), F.sum("invalid").alias("invalid")
    )
    worst = F.greatest("_inner", F.col("first_ms") - _millis("market_open"), _millis("market_close") - F.col("last_ms")) / 1000
    return out.select("session_date", "symbol", "trades", "first_ms", "last_ms", worst.alias("max_gap_seconds"), "invalid").withColumn("passed", (F.col("max_gap_seconds") <= limit) & (F.col("invalid") == 0))


def trade_gaps(trades: DataFrame, sess: DataFrame, symbols: Sequence[str], limit: float = GAP_SECONDS) -> DataFrame:
    """Every gap over the limit: start, end, seconds; the opening and the close count as sentinels, also without trades.

    Gaps within a half hour come from a window of its own, so that a symbol with most trades is spread; gaps between half hours
    come from one row each."""
    t = in_session(trades, sess, "event_time").select("session_date", "symbol", _millis("event_time").alias("ms"))
    each = sess.select("session_date", F.explode(F.array(_millis("market_open"), _millis("market_close"))).alias("ms"))
    marks = each.select("session_date", F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"), "ms")
    keys = ["session_date", "symbol", "_bucket"]
    rows = t.unionByName(marks).withColumn("_bucket", F.floor(F.col("ms") / 1_800_000))
    rows = rows.withColumn("_start", F.lag("ms").over(W.partitionBy(*keys).orderBy("ms")))
    # a half hour has at most 1800 / limit gaps over the limit
    inner = F.collect_list(F.when((F.col("ms") - F.col("_start")) / 1000 > limit, F.struct(F.col("_start").alias("start_ms"), F.col("ms").alias("end_ms"))))
    parts = rows.groupBy(*keys).agg(F.min("ms").alias("_first"), F.max("ms").alias("_last"), inner.alias("_inner"))
    parts = parts.withColumn("_before", F.lag("_last").over(W.partitionBy("session_date", "symbol").orderBy("_bucket")))
    parts = parts.select("session_date", "symbol", F.explode(F.concat("_inner", F.array(F.struct(F.col("_before").alias("start_ms"), F.col("_first").alias("end_ms"))))).alias("_g"))
    gaps = parts.select("session_date", "symbol", "_g.*").withColumn("seconds", (F.col("end_ms") - F.col("start_ms")) / 1000)
    return gaps.where(F.col("seconds") > limit)


def missing_bars(bars: DataFrame, sess: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return session_grid(sess, symbols).join(bars.select("symbol", "window_start"), ["symbol", "window_start"], "left_anti")


def interior_gaps(bars: DataFrame, sess: DataFrame, minutes: int = 30) -> DataFrame:
    """Bars that a symbol lacks between its first and last of a session."""
    b = in_session(bars, sess, "window_start")
    span = b.groupBy("session_date", "symbol").agg(F.min("window_start").alias("_a"), F.max("window_start").alias("_b"))
    grid = span.select("session_date", "symbol", F.explode(F.sequence("_a", "_b", F.expr(f"interval {minutes} minutes"))).alias("window_start"))
    return grid.join(bars.select("symbol", "window_start"), ["symbol", "window_start"], "left_anti").select("session_date", "symbol", "window_start")


def qualify_sessions(bars: DataFrame, sess: DataFrame, symbols: Sequence[str], minutes: int = 30) -> DataFrame:
    """Evidence of each session and symbol: expected, observed, duplicates, off_grid, invalid, bad_bounds, bad_width, passed.

    A bar is invalid if its open, high, low, close or volume is missing, not finite or not above 0."""
    numbers = ["open", "high", "low", "close", "total_volume"]
    bad = F.greatest(*[(F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.col(c) <= 0) | (F.abs(F.col(c).cast("double")) == float("inf"))).cast("int") for c in numbers]) == 1
    bounds = (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high"))
    b = in_session(bars, sess, "window_start")
    off = (_millis("window_start") - _millis("market_open")) % (minutes * 60_000) != 0
    seen = b.groupBy("session_date", "symbol").agg(
        F.count("*").alias("rows"), F.count_distinct("window_start").alias("observed"), F.count_if(off).alias("off_grid"), F.count_if(bad).alias("invalid"), F.count_if(bounds).alias("bad_bounds"),
        F.count_if(_millis("window_end") - _millis("window_start") != minutes * 60_000).alias("bad_width"),
    )
    expected = session_grid(sess, symbols, minutes).groupBy("session_date", "symbol").agg(F.count("*").alias("expected"))
    out = expected.join(seen, ["session_date", "symbol"], "left").fillna(0)
    out = out.withColumn("duplicates", F.col("rows") - F.col("observed")).drop("rows")
    passed = (F.col("observed") == F.col("expected")) & (F.col("duplicates") + F.col("off_grid") + F.col("invalid") + F.col("bad_bounds") + F.col("bad_width") == 0)
    return out.withColumn("passed", passed)


def qualify_history(bars: DataFrame, sess: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Per symbol over all sessions: sessions, qualified, missing, off_session, duplicates, passed."""
    by_session = qualify_sessions(bars, sess, symbols).groupBy("symbol").agg(F.count("*").alias("sessions"), F.count_if("passed").alias("qualified"), F.sum(F.col("expected") - F.least("expected", F.col("observed") - F.col("off_grid"))).alias("missing"))
    grid = session_grid(sess, symbols)
    off = bars.join(grid.select("symbol", "window_start"), ["symbol", "window_start"], "left_anti").groupBy("symbol").agg(F.count("*").alias("off_session"))
    twice = bars.groupBy("symbol", "window_start").agg(F.count("*").alias("n")).groupBy("symbol").agg(F.sum(F.col("n") - 1).alias("duplicates"))
    out = by_session.join(off, "symbol", "left").join(twice, "symbol", "left").fillna(0)
    return out.withColumn("passed", (F.col("sessions") == F.col("qualified")) & (F.col("off_session") + F.col("duplicates") == 0))


def recovery_coverage(trades: DataFrame, sess: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Per session and symbol: expected and observed bars, the missing starts, trades, first and last."""
    t = in_session(trades, sess, "event_time").withColumn("window_start", F.window("event_time", "30 minutes").start)
    have = t.groupBy("session_date", "symbol", "window_start").agg(F.count("*").alias("n"), F.min("event_time").alias("a"), F.max("event_time").alias("b"))
    grid = session_grid(sess, symbols).join(have, ["session_date", "symbol", "window_start"], "left")
    lacking = F.array_sort(F.collect_list(F.when(F.col("n").isNull(), F.date_format("window_start", "HH:mm"))))
    return grid.groupBy("session_date", "symbol").agg(F.count("*").alias("expected"), F.count("n").alias("observed"), F.array_join(lacking, ",").alias("missing"), F.coalesce(F.sum("n"), F.lit(0)).alias("trades"), F.min("a").alias("first"), F.max("b").alias("last"))


#: Hex digits of a key's digest that name its node, level by level; a node has up to 256 children.
LEVELS = (6, 4, 2, 0)
LEAF = 64


def digest_tree(bars: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """A hash tree of the rows: level, path, digest, children, and the key (``by``, day) of a leaf.

    A leaf is a key's day of rows (bars: 48 at most); its place in the tree is the digest of its key, so it doesn't move when
    others come or go, and a node's digest is that of its children in order. No array is longer than a node's fan-out, but
    where more than 256 * 16^6 keys are held. A row's volume goes in as a whole number, so large volumes don't lose digits."""
    row = F.sha2(F.to_json(F.struct("symbol", "window_start", "window_end", *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")], F.col("total_volume").cast("decimal(20,0)").alias("total_volume"))), 256)
    day = bars.select(*by, F.to_date("window_start").alias("day"), row.alias("_h"))

    def joined(lines: str) -> Column:
        return F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), ""), 256)

    leaves = day.groupBy(*by, "day").agg(joined("_h").alias("digest"), F.count("*").alias("children"))
    leaves = leaves.select(F.lit(LEAF).alias("level"), F.sha2(F.concat_ws("|", *by, "day"), 256).alias("path"), "digest", "children", *by, "day")
    levels, below = [leaves], leaves
    for n in LEVELS:
        lines = below.select(F.col("path").substr(1, n).alias("_p"), F.concat_ws(":", "path", "digest").alias("_l"))
        below = lines.groupBy("_p").agg(joined("_l").alias("digest"), F.count("*").alias("children")).select(F.lit(n).alias("level"), F.col("_p").alias("path"), "digest", "children")
        levels.append(below)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), levels)


def content_digest(bars: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """One row: how many (key, day) groups there are, and the root of their hash tree, which doesn't depend on the rows' order."""
    tree = digest_tree(bars, by)
    root = tree.where("level = 0").agg(F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)).alias("digest"))
    return tree.where(F.col("level") == LEAF).agg(F.count("*").alias("groups")).crossJoin(root)  # one row each


def differences(left: DataFrame, right: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """(key, day, side) in which two trees of ``digest_tree`` differ: ``changed``, ``left`` or ``right`` if only one has it.

    Both trees are stored by level, as each is asked for level by level; from the root down, only the children of nodes that
    differ are compared."""
    spark = left.sparkSession
    trees = []
    for tree in (left, right):
        path = workspace(spark, "tree")
        tree.write.partitionBy("level").parquet(path)
        trees.append(spark.read.schema(tree.schema).parquet(path))
    paths, both = None, None
    for n in (*reversed(LEVELS), LEAF):
        l, r = (t.where(F.col("level") == n).select("path", F.col("digest").alias(f"_{s}"), *([F.struct(*by, "day").alias(f"_k{s}")] if n == LEAF else [])) for t, s in zip(trees, "lr", strict=True))
        if paths is not None:
            width = LEVELS[LEVELS.index(n) + 1] if n in LEVELS else LEVELS[0]
            l, r = (t.join(paths, F.col("path").substr(1, width) == F.col("_up"), "left_semi") for t in (l, r))
        both = l.join(r, "path", "full").where(~F.col("_l").eqNullSafe(F.col("_r")))
        if n != LEAF:
            path = workspace(spark, "paths")
            both.select(F.col("path").alias("_up")).write.parquet(path)
            paths = spark.read.schema("_up string").parquet(path)
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("changed")
    return both.select(F.coalesce("_kl", "_kr").alias("_k"), side.alias("side")).select("_k.*", "side")


def request_guards(requests: DataFrame, most_days: int = 730) -> DataFrame:
    """``requests`` (start_date, end_date, retrieved_at) with the reasons that refuse them, an empty array if none."""
    days = F.date_diff("end_date", "start_date")
    found = F.array(
        F.when(F.col("start_date").isNull() | F.col("end_date").isNull(), "missing_date"),
        F.when(days < 0, "dates_out_of_order"),
        F.when(days > most_days, "range_too_long"),
        F.when(F.col("retrieved_at") < F.col("end_date"), "unfinished_range"),
    )
    return requests.withColumn("refused", F.array_compact(found))


def history_checks(bars: DataFrame, sess: DataFrame, symbols: Sequence[str], digest: str | None, retrieved_at: Column, now: Column) -> DataFrame:
    """(check, violations) of a whole history: content checksum, symbol set, unfinished sessions, retrieval ahead of the clock,
    missing, off-session and repeated keys, volumes that are no BIGINT."""
    grid = session_grid(sess, symbols)
    keys = ["symbol", "window_start"]
    counted = bars.groupBy(*keys).agg(F.count("*").alias("_n"))
    key_counts = counted.join(grid.select(*keys, F.lit(1).alias("_in")), keys, "full").agg(
        F.count_if(F.col("_n").isNull()).alias("missing_keys"), F.count_if(F.col("_in").isNull()).alias("off_session_keys"), F.coalesce(F.sum(F.greatest(F.col("_n") - 1, F.lit(0))), F.lit(0)).alias("repeated_keys")
    )
    volume = F.col("total_volume")
    rows = bars.agg(F.count_if(volume.isNull() | (volume % 1 != 0) | (volume.cast("double") >= float(2**63))).alias("volume_not_bigint"), F.collect_set("symbol").alias("_have"))
    listed = F.array(*[F.lit(s) for s in symbols])
    rows = rows.select("volume_not_bigint", (F.size(F.array_except("_have", listed)) + F.size(F.array_except(listed, F.col("_have")))).cast("long").alias("symbol_set"))
    ends = sess.agg(F.count_if(F.col("market_close") > F.least(retrieved_at, now)).alias("unfinished_sessions"), (F.count("*") == 0).cast("long").alias("no_sessions"))
    one = key_counts.crossJoin(rows).crossJoin(ends).withColumn("retrieved_ahead", (retrieved_at > now + F.expr("interval 5 minutes")).cast("long"))  # one row each
    names = ["missing_keys", "off_session_keys", "repeated_keys", "volume_not_bigint", "symbol_set", "unfinished_sessions", "no_sessions", "retrieved_ahead"]
    if digest is not None:
        one = one.crossJoin(content_digest(bars).select((F.col("digest") != digest).cast("long").alias("checksum")))
        names.append("checksum")
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in names])))
