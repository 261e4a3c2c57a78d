"""Line dedup by winnowing, in DataFrame functions only.

Lines are compared after trimming and lower-casing; lines without words match nothing and never break a run. From every line
of a document runs the shortest window of lines with at least ``min_words`` words, and to every line such a window backwards.

1. Select: each window selects its smallest line digest (of equal ones the last). Neighbouring windows mostly select the same
   line, so the selected places, the fingerprints, are fewer than the lines; a run of at least ``min_words`` words that two
   places share has a window in it, which selects the same line of both.
2. Join positions: a fingerprint whose line is selected at one place only has no partner and leaves with all its windows.
3. Extend: of the other places the windows that selected them, which reach forwards and backwards as far as ``min_words`` words,
   are compared in full. A window's whole content is its key, so that the copies of a passage meet its first place (by doc_id,
   then text, then line) and not each other; and as every line begins one window and ends another, windows that meet an
   earlier place cover each shared run up to its last line either way.
4. Delete: windows that overlap are one run. Runs are deleted in all documents but the first that has them.

Lines and contents that are very common (more places than a small share of a task's rows) are joined by broadcast, as there are
at most ``HOT`` such keys a partition; all others are merged. A text that occurs in the same document again counts as later
if the windows do not overlap. Rows with equal doc_id and text are one document, and all its rows get the same result. Defined
cases: null and empty texts stay as they are; a null doc_id comes after all others; a document with nothing but repeats keeps
its row, with an empty text; other columns are kept, whatever their names, but for n_lines and n_deleted, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.llm.common import WORD, cut, partitions

MIN_WORDS = 50
#: Keys a shuffle partition that are joined by broadcast: those with more than one row in so many of a partition's.
HOT = 16
DOC = ["doc_id", "_text"]


def digest(col: Column) -> Column:
    return F.unhex(F.md5(col.cast("binary")))


def text_key(text: Column) -> Column:
    return digest(F.coalesce(text, F.lit("")))


def line_arrays(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text digest): its lines with words, as digests, word counts and places."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(digest(F.lower(F.trim(x))).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("n"), i.alias("at")),
    )
    d = docs.where("text is not null").select("doc_id", text_key(F.col("text")).alias("_text"), F.filter(lines, lambda x: x["n"] > 0).alias("_l"))
    return d.where("size(_l) > 0").groupBy(*DOC).agg(F.first("_l").alias("_l"))


def fingerprints(lines: DataFrame, min_words: int) -> DataFrame:
    """One row a selected place: f (the line's digest), doc_id, _text, and the windows that selected it, each with its first
    and last line in the text and the digest of its content."""
    each = lines.select(*DOC, F.explode("_l").alias("_x")).select(*DOC, "_x.*")
    doc = W.partitionBy(*DOC)
    each = each.withColumn("_end", F.sum("n").over(doc.orderBy("at").rowsBetween(W.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - F.col("n"))
    # as every line has words, the lines that start within the next min_words - 1 words are the shortest window with min_words
    ahead = doc.orderBy("_start").rangeBetween(0, min_words - 1)
    behind = doc.orderBy("_end").rangeBetween(1 - min_words, 0)

    def window(over, whole: Column) -> Column:
        least = F.min(F.struct("h", (-F.col("at")).alias("at"))).over(over)
        w = F.struct(F.min("at").over(over).alias("first"), F.max("at").over(over).alias("last"), least["h"].alias("f"), (-least["at"]).alias("at"), F.collect_list("h").over(over).alias("hs"))
        return F.when(whole, w)

    each = each.select(*DOC, window(ahead, F.max("_end").over(ahead) - F.col("_start") >= min_words).alias("_ahead"), window(behind, F.col("_end") >= min_words).alias("_behind"))
    each = each.select(*DOC, F.explode(F.array_compact(F.array("_ahead", "_behind"))).alias("_w")).select(*DOC, "_w.*").dropDuplicates([*DOC, "first", "last"])
    key = digest(F.concat_ws("", F.transform("hs", F.hex)))
    return each.groupBy(*DOC, "at").agg(F.first("f").alias("f"), F.collect_list(F.struct("first", "last", key.alias("key"))).alias("windows")).select("f", *DOC, "windows")


def meet(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``found`` (one row a key, _n of ``rows`` each), where hot keys do not meet in one task."""
    least = rows.count() // (HOT * partitions(rows.sparkSession)) + 1
    hot = F.broadcast(found.where(F.col("_n") > least))  # at most HOT a partition
    rest = rows.join(hot.select(key), key, "left_anti").join(found.where(F.col("_n") <= least).hint("merge"), key)
    return rows.join(hot, key).unionByName(rest).drop("_n")


def repeats(lines: DataFrame, min_words: int) -> DataFrame:
    """doc_id, _text, runs: the first and last lines of what is to be deleted, in order and disjoint."""
    prints = cut(fingerprints(lines, min_words), "line-prints")
    shared = cut(prints.groupBy("f").agg(F.count("*").alias("_n")).where("_n > 1"), "line-shared")
    windows = cut(meet(prints, shared, "f").select(*DOC, F.explode("windows").alias("_w")).select(*DOC, "_w.*"), "line-windows")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_text", F.col("first").alias("at"), F.col("last").alias("end"))
    sources = cut(windows.groupBy("key").agg(F.min(order).alias("source"), F.count("*").alias("_n")).where("_n > 1"), "line-sources")
    later = ~(F.col("doc_id").eqNullSafe(F.col("source.doc_id")) & (F.col("_text") == F.col("source._text"))) | (F.col("first") > F.col("source.end"))
    gone = meet(windows, sources, "key").where(later).select(*DOC, "first", "last")
    doc = W.partitionBy(*DOC).orderBy("first", "last")
    gone = gone.withColumn("_far", F.max("last").over(doc.rowsBetween(W.unboundedPreceding, -1)))
    gone = gone.withColumn("_run", F.sum(F.when(F.col("first") <= F.col("_far"), 0).otherwise(1)).over(doc.rowsBetween(W.unboundedPreceding, 0)))
    runs = gone.groupBy(*DOC, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with text (the lines that stay), n_lines and n_deleted."""
    lines = cut(line_arrays(docs.select("doc_id", "text")), "lines")
    runs = cut(repeats(lines, min_words), "line-runs")
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    d = docs.select(F.struct(*names).alias("row"), text_key(F.col("text")).alias("key"))
    # the runs grow with the documents: they are merged at every size, never broadcast
    runs = runs.select(F.col("doc_id").alias("id"), F.col("_text").alias("of"), "runs").hint("merge")
    d = d.join(runs, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("of")), "left")
    begins = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))

    def cut_out(ls: Column) -> Column:
        ends = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size(ls)))
        kept = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(ls, a + 1, b - a)))
        return F.struct(F.size(ls).alias("n"), F.when(F.col("runs").isNotNull(), kept).alias("kept"))

    # the text is split once a row, not once a run
    d = d.select("row", F.transform(F.array(F.split("row.text", "\n")), cut_out)[0].alias("cut"))
    d = d.select("row", F.col("cut.kept").alias("kept"), F.when(F.col("row.text").isNull(), 0).otherwise(F.col("cut.n")).alias("n"))
    text = F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.array_join("kept", "\n"))
    deleted = F.when(F.col("kept").isNull(), 0).otherwise(F.col("n") - F.size("kept")).cast("long")
    return d.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names], F.col("n").cast("long").alias("n_lines"), deleted.alias("n_deleted"))
