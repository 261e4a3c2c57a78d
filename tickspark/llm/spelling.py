"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the forms they are variants of.

Words and their counts come from all texts. The vocabulary is cut to shards, each with a bit-sliced index: for every position
and letter the set of the shard's words that have this letter there, as a bitset. A word runs through the index letter by
letter, and two sets of words move along, 64 words at a time: those that agree with it so far, and those that differ
by just one error so far. After the letters q of the query and the sets B of the index, with E before and after a letter:

    replaced:  X = (X & B[i][q[i]]) | (E before & ~B[i][q[i]])
    inserted:  X = (X & B[i + 1][q[i]]) | E after          (the set runs one position ahead of the query)
    deleted:   X = (X & B[i][q[i + 1]]) | E after          (the query runs one position ahead of the set)

A shard holds words of a length m and of m + 1. Where two words differ by one error, either the first half of m or the rest,
counted from the end, agrees letter by letter; so shards are dealt by those halves, and a word is in four of them. The pairs whose
first half agrees are found in a shard of first halves, the others in a shard of last ones, so that each pair is found once.
Bits are in order of falling counts, so that the first bit of a result is the most frequent near word; what leaves a
task is one row a word, never a pair. A half that very many words share is cut to blocks, and each pair of blocks is a group.

Defined cases: null and empty texts hold no word; a null id counts as ``null``; runs of letters of any length are words (shards
are measured in letters); rows and ids may repeat and each counts; an empty table gives no row; of equally frequent near
words the first in code-point order is taken; a word whose form is not frequent enough, or that has no near word, is its own root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import ascii_lower, cut

#: Basic Latin letters and U+00C0 to U+00FF.
RUN = "[A-Za-z\u00C0-\u00FF]+"
#: Letters of a shard, about, and of a block.
SHARD = 1 << 15
#: A word counts for so many letters at least, since a bitset has a bit for it at every position.
LEAST = 8
#: 64-bit words of one state of a shard's queries: 2 MB.
STATES = 1 << 18
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def words(docs: DataFrame, modulus: int = 199, least: int = 6, often: int = 5) -> DataFrame:
    """word, n: every run of letters, with a letter deleted where the modulus divides the digest of id and run."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({RUN})"))).alias("run"))
    run = run.withColumn("size", F.length("run")).where(F.col("size") >= least)  # a deletion never makes a run longer
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.col("size")).cast("int")
    cut_run = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("size")))
    word = run.select(F.when(h % modulus == 0, cut_run).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)
    return word.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def codes(many: np.ndarray, size: int) -> np.ndarray:
    """A row of code points a word, all of one length."""
    return many.astype(f"U{size}").view(np.uint32).reshape(len(many), size)


def bitsets(column: np.ndarray, asked: np.ndarray, width: int) -> np.ndarray:
    """For each asked letter the set of index words that have it at one position: the index is used position by position."""
    letters, of = np.unique(asked, return_inverse=True)
    bits = np.zeros((len(letters), width * 64), np.uint8)
    bits[:, : len(column)] = column[None, :] == letters[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[of]


def near_sets(query: np.ndarray, index: np.ndarray, half: int, first: bool) -> np.ndarray:
    """A bitset a query of the index words that are one error away and whose first half agrees (``first``) or does not.

    ``half`` letters are the first half. Lengths differ by at most one; the letters after the first half agree from the end
    where the first half does not."""
    width = -(-len(index) // 64)
    exact, error = np.full((len(query), width), FULL), np.zeros((len(query), width), np.uint64)
    q, w = query.shape[1], index.shape[1]
    ahead_w, ahead_q = (w > q), (q > w)
    if ahead_w or ahead_q:
        error[:] = FULL  # the first letter of the longer one is the error
    for i in range(min(q, w)):
        if first and i == half:
            error = exact.copy() if ahead_w or ahead_q else np.zeros_like(exact)
        if not first and i == half:
            error &= ~exact
        level = bitsets(index[:, i], query[:, i], width)
        moved = bitsets(index[:, i + 1], query[:, i], width) if ahead_w else bitsets(index[:, i], query[:, i + 1], width) if ahead_q else level
        error &= moved
        if first or i < half:
            if ahead_w or ahead_q:
                exact &= level
                error |= exact
            else:
                error |= exact & ~level
                exact &= level
    spare = width * 64 - len(index)
    if spare:
        error[:, -1] &= FULL >> np.uint64(spare)
    return error


def shard_result(part: pa.Table) -> pa.Table:
    """word, n_near, best_n, best of the words of one pair of blocks of a shard."""
    base, first, i, j = (part[c][0].as_py() for c in ("base", "first", "i", "j"))
    part = part.sort_by([("n", "descending"), ("word", "ascending")])  # the index's bits: the most frequent word first
    word, n, size, block = np.array(part["word"].to_pylist(), dtype=object), part["n"].to_numpy(), part["size"].to_numpy(), part["block"].to_numpy()
    found = [[], [], [], []]
    for q, w in ((base, base), (base, base + 1), (base + 1, base)):
        for of, among in {(i, j), (j, i)}:
            asked, held = np.flatnonzero((size == q) & (block == of)), np.flatnonzero((size == w) & (block == among))
            if not len(asked) or not len(held):
                continue
            index = codes(word[held], w)
            step = max(1, STATES // -(-len(held) // 64))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                sets = near_sets(codes(word[some], q), index, base // 2, first)
                hit, count, bit = summary(sets)
                for column, values in zip(found, (word[some[hit]], count, n[held[bit]], word[held[bit]]), strict=True):
                    column.extend(values.tolist())
    return pa.table({"word": pa.array(found[0], pa.string()), "n_near": pa.array(found[1], pa.int64()), "best_n": pa.array(found[2], pa.int64()), "best": pa.array(found[3], pa.string())})


def summary(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of sets that are not empty, their counts and their first bits."""
    count = np.bitwise_count(sets).sum(axis=1).astype(np.int64)
    hit = np.flatnonzero(count)
    at = (sets[hit] != 0).argmax(axis=1)
    lowest = sets[hit, at]
    return hit, count[hit], 64 * at + np.bitwise_count((lowest & (~lowest + np.uint64(1))) - np.uint64(1)).astype(np.int64)


def near(vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n_near, best_n, best: of every word that has near words."""
    size = F.length("word")
    halves = []
    for longer in (0, 1):
        base = size - longer
        for first in (True, False):
            half = F.col("word").substr(F.lit(1), F.floor(base / 2).cast("int")) if first else F.col("word").substr(size - (base - F.floor(base / 2)).cast("int") + 1, size)
            halves.append(F.struct(base.alias("base"), F.lit(first).alias("first"), half.alias("half")))
    rows = vocabulary.select("word", "n", size.alias("size"), F.inline(F.array(*halves))).where("base > 0")
    weight = F.greatest(F.col("size"), F.lit(LEAST))
    cells = rows.groupBy("base", "first", "half").agg(F.count("*").alias("words"), F.sum(weight).alias("letters"))
    cells = cut(cells.where("words > 1"), "spelling-cells")  # a half that one word has joins nothing
    total = cells.groupBy("base", "first").agg(F.sum("letters").alias("_letters"))  # two rows a word length
    shards = F.greatest(F.lit(1), F.ceil(F.col("_letters") / shard)).cast("long")
    blocks = F.least(F.col("words"), F.greatest(F.lit(1), F.ceil(F.col("letters") / (2 * shard)))).cast("int")
    place = cells.join(total, ["base", "first"]).select("base", "first", "half", F.pmod(F.xxhash64("half"), shards).alias("shard"), blocks.alias("blocks"))
    placed = rows.join(place, ["base", "first", "half"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "of": F.when(F.col("blocks") > 1, F.col("half"))})
    found = met.select("base", "first", "shard", "of", "i", "j", "block", "size", "word", "n").groupBy("base", "first", "shard", "of", "i", "j").applyInArrow(shard_result, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", (-F.col("_b.n")).alias("best_n"), F.col("_b.word").alias("best"))


def variants(docs: DataFrame, factor: int = 5, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that is frequent enough."""
    vocabulary = cut(words(docs, **options), "spelling-words")
    fits = F.col("best_n") >= F.lit(factor) * F.col("n")
    rows = vocabulary.join(near(vocabulary), "word", "left")
    rows = cut(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")), "spelling-forms")
    return rows.join(roots(rows, factor), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame, factor: int) -> DataFrame:
    """word, root of the words with a form. A form counts ``factor`` times as often, so a chain is at most a logarithm long, and each
    step below doubles what is followed."""
    top = rows.agg(F.max("form_n")).first()[0]
    steps = cut(rows.where("form is not null").select("word", F.col("form").alias("root")), "spelling-steps")
    longest, reach = (int(np.ceil(np.log(max(top, 1)) / np.log(factor))) + 1 if top else 0), 1
    while reach < longest:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = cut(steps.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "spelling-steps")
        reach *= 2
    return steps
