"""The traded universe: cleaning, checks, churn and artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOL = r"^[A-Z][A-Z0-9.-]{0,9}$"
LEAST, MOST, CHURN = 450, 550, 0.10


def clean(companies: DataFrame) -> DataFrame:
    """Symbols without spaces of any kind, in capitals; one row of equal ones; conflicting tells symbols with several companies."""
    symbol = F.upper(F.trim(F.regexp_replace("symbol", "\u00a0", " ")))
    c = companies.withColumns({"symbol": symbol, "company_name": F.trim("company_name")})
    g = c.groupBy("symbol").agg(F.min("company_name").alias("company_name"), F.min("sector").alias("sector"), F.count_distinct(F.struct("company_name", "sector")).alias("_n"))
    return g.select("symbol", "company_name", "sector", (F.col("_n") > 1).alias("conflicting"), F.coalesce(F.col("symbol").rlike(SYMBOL), F.lit(False)).alias("valid"))


def candidate_checks(cleaned: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row: members, invalid and conflicting symbols, and whether the candidate may go on."""
    c = cleaned.agg(F.count("*").alias("members"), F.count_if(~F.col("valid")).alias("invalid"), F.count_if("conflicting").alias("conflicting"))
    return c.withColumn("passed", F.col("members").between(least, most) & (F.col("invalid") + F.col("conflicting") == 0))


def changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """symbol and change (added or removed)."""
    p, c = previous.select("symbol").distinct(), current.select("symbol").distinct()
    return c.join(p, "symbol", "left_anti").withColumn("change", F.lit("added")).unionByName(p.join(c, "symbol", "left_anti").withColumn("change", F.lit("removed")))


def churn(previous: DataFrame, current: DataFrame, limit: float = CHURN) -> DataFrame:
    """One row: additions, removals, their share of the previous members, and whether it is within the limit."""
    n = previous.agg(F.count_distinct("symbol").alias("previous"))
    d = changes(previous, current).agg(F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "removed").alias("removed"))
    out = n.crossJoin(d).withColumn("churn", F.try_divide(F.greatest("added", "removed"), "previous"))
    return out.withColumn("accepted", F.coalesce(F.col("churn") <= limit, F.lit(False)))


def artifact_digest(cleaned: DataFrame) -> DataFrame:
    """Count, order-independent digest and size of the symbol list, as a manifest holds them."""
    line = F.concat_ws(",", "symbol", "company_name", "sector")
    rows = cleaned.select(F.substring(F.sha2(F.coalesce("symbol", F.lit("")), 256), 1, 2).alias("_b"), F.sha2(line, 256).alias("_h"), F.octet_length(line).alias("_s"))
    parts = rows.groupBy("_b").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("_h")), ""), 256).alias("_h"), F.count("*").alias("n"), F.sum("_s").alias("s"))
    return parts.agg(F.sum("n").alias("members"), F.sum("s").alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("_b", "_h"))), ""), 256).alias("digest"))


def verify(cleaned: DataFrame, manifest: DataFrame) -> DataFrame:
    """Whether the artifact still is what its manifest (members, bytes, digest) says."""
    return artifact_digest(cleaned).crossJoin(F.broadcast(manifest.toDF("m_members", "m_bytes", "m_digest"))).select(((F.col("members") == F.col("m_members")) & (F.col("bytes") == F.col("m_bytes")) & (F.col("digest") == F.col("m_digest"))).alias("intact"), "members")


SCHEMA_VERSION = "1.0"
COLUMNS = ("symbol", "company_name", "sector")


def artifact_lines(cleaned: DataFrame) -> DataFrame:
    """(artifact, line, symbol): the lines of each artifact; companies.csv has its header apart."""
    quoted = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in COLUMNS])
    kinds = F.array(
        F.struct(F.lit("companies.csv").alias("artifact"), quoted.alias("line")),
        F.struct(F.lit("companies.json").alias("artifact"), F.to_json(F.struct(*COLUMNS)).alias("line")),
        F.struct(F.lit("symbols.txt").alias("artifact"), F.col("symbol").alias("line")),
    )
    return cleaned.select("symbol", F.inline(kinds))


def artifacts(cleaned: DataFrame, most: int = MOST) -> DataFrame:
    """Per artifact: members, bytes and SHA-256 of its lines in the order of the symbols. A universe is at most ``most`` rows."""
    lines = artifact_lines(cleaned.orderBy("symbol").limit(most + 1))
    body = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("symbol", "line"))), lambda x: x["line"]), "\n"), F.lit("\n"))
    g = lines.groupBy("artifact").agg(F.count("*").alias("members"), body.alias("_b"))
    over = F.when(F.col("members") > most, F.raise_error(F.lit("the universe has too many members"))).otherwise(F.col("members"))
    return g.select("artifact", over.alias("members"), F.octet_length("_b").cast("long").alias("bytes"), F.sha2(F.col("_b").cast("binary"), 256).alias("sha256"))


def export(cleaned: DataFrame, folder: str, run_id: str, fetched_at: Column) -> DataFrame:
    """Writes the universe as CSV, JSON and text, one file each in symbol order, and then the pointer with what they hold."""
    lines = artifact_lines(cleaned).repartition(1).sortWithinPartitions("artifact", "symbol")  # at most a few hundred rows
    for (name,) in [("companies.csv",), ("companies.json",), ("symbols.txt",)]:
        lines.where(F.col("artifact") == name).select("line").write.mode("errorifexists").text(f"{folder}/{run_id}/{name}")
    names = cleaned.agg(F.array_sort(F.collect_list("symbol")).alias("symbols"), F.count("*").alias("constituent_count"))
    found = artifacts(cleaned).agg(F.array_sort(F.collect_list(F.struct("artifact", "members", "bytes", "sha256"))).alias("artifacts"))
    pointer = names.crossJoin(found).select(F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(run_id).alias("run_id"), fetched_at.cast("string").alias("fetched_at"), "*")
    pointer.coalesce(1).write.mode("overwrite").json(f"{folder}/current")
    return pointer


def governed_checks(pointer: DataFrame, lines: DataFrame, now: Column, hours: int = 30) -> DataFrame:
    """One row with the reasons that refuse the universe a pointer names, none if it may be used; ``lines``: the text of
    symbols.txt, in any order."""
    body = F.concat(F.array_join(F.array_sort(F.collect_list("value")), "\n"), F.lit("\n"))
    read = lines.agg(F.array_sort(F.collect_list("value")).alias("_symbols"), F.count("*").alias("_n"), F.count_distinct("value").alias("_d"), F.octet_length(body).alias("_bytes"), F.sha2(body.cast("binary"), 256).alias("_sha"))
    p = pointer.withColumn("_a", F.filter("artifacts", lambda a: a["artifact"] == "symbols.txt")[0]).crossJoin(F.broadcast(read))
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("fetched_at").cast("timestamp"))) / 3600
    reasons = F.array(
        F.when(~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)), "unsupported_schema"),
        F.when(age < 0, "fetched_in_the_future"),
        F.when(age > hours, "stale"),
        F.when(F.col("_bytes") != F.col("_a.bytes"), "size"),
        F.when(F.col("_sha") != F.col("_a.sha256"), "checksum"),
        F.when(F.col("_n") != F.col("constituent_count"), "count"),
        F.when(F.col("_symbols") != F.col("symbols"), "symbols"),
        F.when(F.col("_n") != F.col("_d"), "duplicates"),
    )
    return p.select("run_id", F.col("symbols"), F.array_compact(reasons).alias("refused"))


def governed(spark, folder: str, now: Column, hours: int = 30) -> DataFrame:
    """The symbols of the universe that ``current`` points to, after all checks."""
    pointer = spark.read.json(f"{folder}/current")
    run = pointer.first().run_id
    found = governed_checks(pointer, spark.read.text(f"{folder}/{run}/symbols.txt"), now, hours).first()
    if found.refused:
        raise ValueError(f"the universe is refused: {found.refused}")
    return spark.createDataFrame([(s,) for s in found.symbols], "symbol string")
