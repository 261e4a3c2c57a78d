"""Near duplicates: an exact Jaccard join of word n-gram sets by PartEnum signatures, and the groups its links form.

Sets are put in size bands so that two sets with enough similarity lie in one band or in neighbouring ones, and a set gives
signatures for its own band and for the next. In a band, sets that are similar enough differ in at most ``k`` elements. The
feature domain is dealt to first-level parts, and each of these to ``SECOND`` second-level partitions. With ``n1`` parts where
``(DIFFER + 1) * n1 > k``, two such sets have a part in which they differ in at most ``DIFFER`` elements, so that they agree in
at least ``SECOND - DIFFER`` of its partitions. All subsets of that many partitions are enumerated, and the elements that a
set has in a subset are one signature: the two sets share one. ``spare`` more parts make sure that they agree so in
``spare + 1`` parts; a set with at most ``spare`` parts that have an empty signature leaves the empty ones out, for it agrees
with any partner in another part; the few sets with more give the empty ones too. Nothing is missed.

Documents with the same set are one class before any of this; classes are joined, copies never. All signatures of a band with
the same smallest class make one candidate group, which holds their classes once each. A group is cut into blocks, and each
pair of blocks is a task's work. First only sketches meet (how many elements lie in each of some buckets; the differences of
two sketches never add up to more than the sets differ), and classes that can't link to any other of the group leave it. Then
the sets of the rest are compared in full through their inverted index, and of the links found only those that connect
what was apart are sent on, at most one a set. So the links are exact and pairs are never listed.

Texts are known by the 128 bits of their MD5, classes by 64 bits that are checked to be free of collisions, shingles by 64 bits.

Defined cases: a text with fewer than n words is one shingle of all its words; null, empty and blank texts have no set and
are alone; repeated rows are copies; rows that share an id but not a text are documents of their own; a null doc_id can have
links but never names a group (a group of only such ids has the id null); other columns are not read; equal sets are always
linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut
from tickspark.llm.common import mix64 as mix

N = 5
SIMILARITY = (80, 100)
#: Second-level partitions of a first-level part, and in how many of these similar sets may differ.
SECOND, DIFFER = 3, 1
SUBSETS = list(combinations(range(SECOND), SECOND - DIFFER))
#: Sets of a candidate group that are compared in one go; a larger group makes a task for each pair of blocks.
BLOCK = 512
#: Buckets of the smallest sketch; larger sets have powers of two with 4 to 8 elements a bucket.
BUCKETS = 128


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The set of each text as a sorted array of 64-bit hashes."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = pc.list_flatten(words)
    full = pc.not_equal(pc.binary_length(flat), 0)
    lengths = np.bincount(pc.list_parent_indices(words).to_numpy()[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    coded = flat.filter(full).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], dtype=np.uint64)
    h = hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        odd = [mix(np.array([i + 7], dtype=np.uint64))[0] | np.uint64(1) for i in range(n)]
        at = 0
        for m in lengths:
            w = h[at : at + m]
            at += m
            k = min(n, m)
            total = np.zeros(max(0, m - k + 1) if m else 0, np.uint64)
            for i in range(k):
                total += w[i : m - k + 1 + i] * odd[i]
            yield np.unique(mix(total, k))


@cache
def bands(num: int, den: int) -> list[tuple[int, int]]:
    """First and last size of each band; sizes up to 10^9."""
    out, low = [], 1
    while low < 10**9:
        out.append((low, low * den // num))
        low = out[-1][1] + 1
    return out


@cache
def parts_of(band: int, num: int, den: int) -> tuple[int, int]:
    """First-level parts of the sets of this band and of the one before it, and the spare ones; (0, 0) if these link only to
    their equals."""
    k = 2 * bands(num, den)[band][1] * (den - num) // (den + num)
    if not k:
        return 0, 0
    needed = -(-(k + 1) // (DIFFER + 1))
    least = bands(num, den)[max(band - 1, 0)][0]

    def over(spare: int) -> float:  # how likely the smallest set has empty signatures in more than the spare parts, about
        parts = needed + spare
        rate = parts * len(SUBSETS) * math.exp(-least / parts * (SECOND - DIFFER) / SECOND)
        return 1 - sum(math.exp(-rate + i * math.log(rate) - math.lgamma(i + 1)) for i in range(spare + 1))

    spare = min(range(min(k, 20) + 1), key=lambda t: (max(over(t), 0.02), t))
    return needed + spare, spare


def signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Of a set, for its band and the next."""
    size = len(s)
    all_bands = bands(num, den)
    band = next(i for i in range(int(math.log(size) / math.log(den / num) / 2) if size > 8 else 0, len(all_bands)) if all_bands[i][1] >= size) if size else 0
    out = []
    x, y = mix(s, 11) >> np.uint64(32), mix(s, 1001)
    low, high = (y & np.uint64(0xFFFFFFFF)).astype(np.float64), (y >> np.uint64(32)).astype(np.float64)
    for j in (band, band + 1):
        parts, spare = parts_of(j, num, den)
        if not parts or not size:
            continue
        cells = parts * SECOND
        cell = (x * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        lows, highs, numbers = (np.bincount(cell, weights=w, minlength=cells).reshape(parts, SECOND) for w in (low, high, None))
        # one row a part, one column a subset of its partitions
        lows, highs, numbers = (np.stack([v[:, list(some)].sum(1) for some in SUBSETS], 1) for v in (lows, highs, numbers))
        name = np.arange(parts * len(SUBSETS), dtype=np.uint64).reshape(parts, -1) + np.uint64(j << 32)
        with np.errstate(over="ignore"):
            sums = mix(lows.astype(np.uint64) + (highs.astype(np.uint64) << np.uint64(32)), 3) + mix(name, 5)
        sums = (mix(sums) & ~np.uint64(63)) | np.uint64(j & 63)  # the last bits tell the band
        full = numbers > 0
        out.append(sums[full] if (~full.all(1)).sum() <= spare else sums.ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def class_of(s: np.ndarray, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed)


def sketch(s: np.ndarray) -> bytes:
    """How many elements lie in each bucket, up to 255."""
    n = max(BUCKETS, 1 << max(0, (len(s) // 4).bit_length() - 1))
    return np.minimum(np.bincount((mix(s, 77) >> np.uint64(32)).astype(np.int64) % n, minlength=n), 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows with as many buckets as the smallest has."""
    least = min(len(x) for x in sketches)
    return np.stack([np.frombuffer(x, np.uint8).astype(np.int32).reshape(-1, least).sum(0) for x in sketches])


def text_name(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signed_int(i: int) -> int:
    return i if i < 1 << 63 else i - (1 << 64)


def classes(docs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """doc_id, name (of the text), n_shingles, c (the class; null without words) and sketch of every document, and the seed
    whose 64-bit class ids are verified to be different for different sets."""
    for seed in range(8):

        def to_classes(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sizes, ids, checks, sketches = [], [], [], []
                for s in shingle_sets(b.column("text"), n):
                    sizes.append(len(s))
                    ids.append(signed_int(class_of(s, seed)) if len(s) else None)
                    checks.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sketches.append(sketch(s) if len(s) else None)
                columns = [b.column("doc_id"), b.column("name"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(checks, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "name", "n_shingles", "c", "check", "sketch"])

        named = docs.select("doc_id", text_name(F.col("text")).alias("name"), "text")
        rows = cut(named.mapInArrow(to_classes, "doc_id long, name binary, n_shingles long, c long, check binary, sketch binary"), "classes")
        if rows.where("c is not null").groupBy("c").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b").isEmpty():
            return rows.drop("check"), seed
    raise ValueError("class ids collide with every seed")


def sets_of(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """c and set (64-bit hashes, sorted) of the classes in ``wanted`` (c, doc_id, name: a document of the class).

    Only these documents' texts are cut into shingles."""

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array([s.tobytes() for s in shingle_sets(b.column("text"), n)], pa.binary())], ["c", "set"])

    named = docs.select(F.col("doc_id").alias("_id"), text_name(F.col("text")).alias("_of"), "text")
    texts = named.join(wanted, (F.col("_of") == F.col("name")) & F.col("_id").eqNullSafe(F.col("doc_id"))).select("c", "text")
    return texts.mapInArrow(to_sets, "c long, set binary").dropDuplicates(["c"])  # repeated rows


def spanning_links(cs: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect what the links among these sets connect."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    value, owner = flat[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    end = np.append(first[1:], len(value))
    term = np.empty(len(flat), np.int64)
    term[order] = np.repeat(np.arange(len(first)), end - first)
    starts = np.append(0, np.cumsum(size))
    common = end - first > 1
    root, links = np.arange(len(sets)), []
    for i in range(len(sets)):
        t = term[starts[i] : starts[i + 1]]
        t = t[common[t]]
        if not len(t) or (root == root[i]).all():
            continue
        met = np.bincount(np.concatenate([owner[a:b] for a, b in zip(first[t], end[t], strict=True)]), minlength=len(sets))
        near = (met * den >= (size + size[i] - met) * num) & (root != root[i])
        for j in np.flatnonzero(near):
            if root[j] != root[i]:
                links.append((int(cs[i]), int(cs[j])))
                root[root == root[j]] = root[i]
    return links


def in_blocks(group: DataFrame) -> DataFrame:
    """(g, c) to (task, g, c): a class is in a task for each pair of blocks that its own block is in."""
    counted = group.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    of = group.join(counted, "g").withColumn("_block", F.pmod(F.xxhash64("c"), F.col("_blocks").cast("long")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: F.struct(F.least("_block", k).alias("x"), F.greatest("_block", k).alias("y")))
    return of.select("g", "c", F.explode(pairs).alias("_xy")).select(F.xxhash64("g", "_xy.x", "_xy.y").alias("task"), "g", "c")


def may_link(group: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """The classes (g, c) of each group that some other class of it could be linked to, by sizes and sketches."""

    def keep(rows: pa.Table) -> pa.Table:
        size = rows.column("n_shingles").to_numpy()
        x = folded(rows.column("sketch").to_pylist())
        near = np.zeros(len(size), bool)
        for i in range(len(size)):
            far = np.abs(x - x[i]).sum(1) * (den + num) > (size + size[i]) * (den - num)
            far[i] = True
            near[i] = not far.all()
        return rows.select(["g", "c"]).filter(pa.array(near))

    classes_ = members.where("c is not null").groupBy("c").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    return in_blocks(group).join(classes_, "c").groupBy("task").applyInArrow(keep, "g long, c long").distinct()


def compared(group: DataFrame, docs: DataFrame, n: int, members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect the classes (c) of each candidate group (g) as far as their similarities do."""
    one = members.where("c is not null").groupBy("c").agg(F.min(F.struct("doc_id", "name")).alias("_one"))
    wanted = one.join(group.select("c").distinct(), "c", "left_semi").select("c", "_one.*")
    sets = sets_of(docs, n, wanted)

    def link(rows: pa.Table) -> pa.Table:
        cs = rows.column("c").to_numpy()
        order = np.argsort(cs)
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("set").to_pylist()]
        found = spanning_links(cs[order], [sets[i] for i in order], num, den)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return in_blocks(group).select("task", "c").join(sets, "c").groupBy("task").applyInArrow(link, "a long, b long")


def groups(links: DataFrame) -> DataFrame:
    """c and root (the smallest c that is reachable) of every class with links, by alternating stars."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = cut(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("c"), F.col("v").alias("root"))
        state = now


def grouped(docs: DataFrame, n: int, similarity: tuple[int, int]) -> DataFrame:
    """doc_id, name, n_shingles and root (the smallest class that links reach; null without words) of every row of ``docs``."""
    num, den = similarity
    bound_batches(docs.sparkSession)
    members, seed = classes(docs, n)

    def to_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            sigs, cs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for s in shingle_sets(b.column("text"), n):
                if len(s) and (c := class_of(s, seed)) not in seen:
                    seen.add(c)
                    sigs.append(signatures(s, num, den))
                    cs.append(np.full(len(sigs[-1]), c, np.uint64))
            yield pa.RecordBatch.from_arrays([signed(np.concatenate(sigs)), signed(np.concatenate(cs))], ["sig", "c"])

    sigs = docs.select("text").mapInArrow(to_signatures, "sig long, c long")
    shared = sigs.withColumn("a", F.min("c").over(W.partitionBy("sig"))).withColumn("_most", F.max("c").over(W.partitionBy("sig")))
    group = shared.where("a < _most").select(F.xxhash64("a", F.col("sig").bitwiseAND(F.lit(63))).alias("g"), "c").distinct()
    group = cut(may_link(cut(group, "group"), members, num, den), "group")
    root = groups(cut(compared(group, docs, n, members, num, den), "links"))
    return members.join(root, "c", "left").select("doc_id", "name", "n_shingles", F.coalesce("root", "c").alias("root"))


def near_duplicates(docs: DataFrame, n: int = N, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row of ``docs``."""
    found = cut(grouped(docs, n, similarity), "grouped")
    named = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("_group"))
    return found.join(named, "root", "left").select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("_group")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = N, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One document of each group, the one with the smallest doc_id (null last; then by its text's digest), and all that have
    no links. A document is a row's doc_id and text: rows that repeat both are one, rows without words always stay."""
    found = cut(grouped(docs, n, similarity).where("root is not null").select("root", F.col("doc_id").alias("_id"), F.col("name").alias("_of")), "grouped")
    order = F.struct(F.col("_id").isNull().alias("last"), "_id", "_of")
    each = cut(found.groupBy("root", "_id", "_of").agg(F.count("*").alias("_n")), "grouped")
    first = each.groupBy("root").agg(F.min(order).alias("_first"))
    each = each.join(first, "root").select("_id", "_of", "_n", (F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_of") == F.col("_first._of"))).alias("_stays"))
    marks = cut(each.where("not _stays or _n > 1"), "marks")
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_name(F.col("text")).alias("of"))

    def marked(how: str, some: DataFrame, of: DataFrame) -> DataFrame:
        return of.join(some.select("_id", "_of"), F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("of") == F.col("_of")), how)

    again = marks.where("_stays")
    if again.isEmpty():
        return marked("left_anti", marks, rows).select("row.*")
    once = marked("left_semi", again, rows).withColumns({"id": F.col("row.doc_id")}).dropDuplicates(["id", "of"])
    return marked("left_anti", marks, rows).select("row.*").unionByName(once.select("row.*"))
