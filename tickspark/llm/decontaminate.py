"""Benchmark decontamination: a prefix-filtered join of item windows with documents, exact on every window.

An item is cut into windows of consecutive words (a shorter item is one window). A document that contains a window contains
all its words, so for a containment of 1 one prefix word is enough: the window's words are ordered by how often the documents
use them, and the rarest is joined with the document's words. The place of that word in the window fixes where the window
would start; the length and position bounds discard what would not fit, and the words of the window are compared in full.

Word counts are taken over all documents. The windows are gathered in blocks of at most ``block_bytes`` (a larger benchmark
makes more blocks, and the documents pass through one after the other); documents are never shuffled.

Defined cases: a null text or one without words has 0 words and is clean; an item that is null or has no words has no window;
items with equal windows all count; a null item_id counts as the item "null"; rows and ids may repeat; other columns are
kept, and a column named like an output is replaced; without items every document is clean.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import cut, free

WINDOW = 10
BLOCK_BYTES = 16 << 20
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: A-Z to a-z; 0-9, a-z and everything outside ASCII stay; all else separates words.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(BYTES).split() if text else []


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows (words joined by a space) with the items that have them."""

    def cut_items(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = set()
            for item, text in zip(part["item"], part["text"], strict=True):
                w = words_of(text)
                rows |= {(item, b" ".join(w[i : i + window])) for i in range(max(1, len(w) - window + 1)) if w}
            yield pd.DataFrame(list(rows), columns=["item", "window"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("binary").alias("text"))
    return items.mapInPandas(cut_items, "item string, window binary").groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often the documents use each word of the vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for part in parts:
            here: Counter = Counter()
            for text in part["text"]:
                here.update(words_of(text))
            for w in here.keys() & held.value:
                total[w] += here[w]
        yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


def rarest(words: list[bytes], counts: dict[bytes, int]) -> int:
    """The place of the rarest word; of equals the first in byte order."""
    return min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))


def probe(docs: DataFrame, index: dict[bytes, list[tuple[int, list[bytes], list[str]]]], before: Column) -> Column:
    """The windows of one block that occur in the text, merged with what earlier blocks found."""
    held = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("n_words long, spans array<int>, items array<string>")
    def look(parts: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        index = held.value
        for texts, found in parts:
            out = []
            for text, spans, items in zip(texts, found["spans"], found["items"], strict=True):
                w = words_of(text)
                spans, items = list(spans), set(items)
                for i, word in enumerate(w):
                    if word in index:
                        for at, seq, ids in index[word]:
                            if i >= at and w[i - at : i - at + len(seq)] == seq:  # too short a slice isn't equal
                                spans += (i - at, i - at + len(seq))
                                items.update(ids)
                out.append((len(w), merged(spans), sorted(items)))
            yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return look(F.col("text").cast("binary"), before)


def merged(spans: list[int]) -> list[int]:
    """Starts and ends in turn, as few as possible."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (starts and ends of hit runs of words, in turn), items, contaminated."""
    windows = cut(item_windows(benchmark, window), "windows")
    size = windows.agg(F.coalesce(F.sum(F.octet_length("window") + F.octet_length(F.concat_ws(",", "items"))), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes) or 1
    nothing = F.expr("named_struct('n_words', 0L, 'spans', cast(array() as array<int>), 'items', cast(array() as array<string>))")
    found, hits = free("_found", docs), None
    for k in range(blocks):
        part = [(bytes(r.window).split(), list(r.items)) for r in windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).toLocalIterator()]
        counts = word_counts(docs, {w for seq, _ in part for w in seq})
        index: dict[bytes, list] = {}
        for seq, items in part:
            at = rarest(seq, counts)
            if counts.get(seq[at], 0):
                index.setdefault(seq[at], []).append((at, seq, items))
        if blocks == 1:
            out = docs.withColumn(found, probe(docs, index, nothing))
            break
        # one block's windows are held at a time; what it hits is written, a row for each of the few texts with a hit
        here = docs.select("doc_id", "text").withColumn("_at", nothing).withColumn("_f", probe(docs, index, F.col("_at")))
        here = cut(here.where("size(_f.spans) > 0").select(F.md5(F.col("text").cast("binary")).alias("_of"), "_f.spans", "_f.items"), "block-hits")
        hits = here if hits is None else hits.unionByName(here)
    if hits is not None:
        out = with_hits(docs, hits, found)
    n_hit = F.aggregate(F.col(found)["spans"], F.lit(0).cast("long"), lambda a, x: x - a)  # ends less starts: the sign turns with each step
    return out.withColumns({"n_words": F.col(found)["n_words"], "n_hit": n_hit, "spans": F.col(found)["spans"], "items": F.col(found)["items"], "contaminated": n_hit > 0}).drop(found)


def with_hits(docs: DataFrame, hits: DataFrame, found: str) -> DataFrame:
    """``docs`` with the hits of all blocks merged; texts are known by their MD5, and equal texts have equal hits."""

    @F.pandas_udf("array<int>")
    def joined(spans: pd.Series) -> pd.Series:
        return pd.Series([merged([int(i) for x in each for i in x]) for each in spans])

    once = hits.groupBy("_of", "spans", "items").agg(F.lit(1).alias("_1"))  # copies of a text first become one row
    each = once.groupBy("_of").agg(F.collect_list("spans").alias("_s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_i"))
    each = each.select("_of", joined("_s").alias("_spans"), "_i")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.md5(F.col("text").cast("binary")).alias("of"))
    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    n_words = F.regexp_count(F.coalesce("row.text", F.lit("")), F.lit(WORD)).cast("long")
    f = F.struct(n_words.alias("n_words"), F.coalesce("_spans", none[0]).alias("spans"), F.coalesce("_i", none[1]).alias("items"))
    return rows.join(each, F.col("of") == F.col("_of"), "left").select("row.*", f.alias(found))
