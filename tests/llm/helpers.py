import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


#: Columns with the names that the operators use inside or return.
CLASHING = ["size", "h", "key", "score", "n_words", "target", "taken", "spans", "c", "sig", "host", "rule", "_votes", "keep", "n_lines", "contaminated", "predicted", "_near", "_q", "_found", "_text", "_runs", "_d", "_t", "_kept", "row", "key", "cut", "kept", "n", "id", "of", "_id", "_of", "_key", "_range", "_hit", "_both", "ids", "word", "form", "v"]


def frame(spark, rows):
    """(doc_id, text, source) rows as documents with columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def odd(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, "a"), (2, "", None), (3, "  \n\t ", "a"), (4, "one", "b"), (5, "Same text here, twice.", None), (5, "Same text here, twice.", None), (None, "no id", "b"), (None, None, None), (7, long, "a"), (8, long + " tail", "a"), (9, "é ü ñ 日本 ‰", "ü"), (10, "\n\n\nlines\n\n", "b")]
    return frame(spark, rows)


def empty(spark):
    return odd(spark).limit(0)
