"""Language-model scoring: a Katz backoff model over words, trained on and evaluated over whole documents.

Counts: words are known by 64-bit hashes, and every training word is a word of the model. The ``vocabulary`` most frequent
ones have short ids and their counts on every executor (a cache: its size changes no result); the others go by their hashes
and meet their counts in joins. Pairs of neighbouring words are counted in a table that is partitioned by history; histories
with a large share of all tokens are dealt over all partitions by pair. Good-Turing discounts are fitted to the counts of
counts, up to ``CUT``. Only words that no training document has share the unknown word.

Probabilities: a pair seen r times has ``d_r * r / c(h)``; any other backs off to ``alpha(h) * P(w)``, where alpha shares what
the discounts took from h among the words not seen after it, so each history's probabilities add up to 1 exactly; the same
goes for single words, whose remainder is the unknown word's. A history without discounted pairs gets half a count to share.

Evaluation: the pairs of all documents are dealt to the table's partitions as sorted, compressed blocks, each partition looks
its pairs up, recursing from pair to word where a pair is missing, and sends back one sum a document and block, with the
hashes of the words outside the cache that were backed off to; these meet the counts of all words.

Defined cases: a null text is empty; an empty text is one end token; equal texts get equal scores (documents are known by a
64-bit hash of the text); a null doc_id trains; without training documents every word is unknown and has the score 0; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut, file_system, mix64, partitions, scratch

#: Words cached on every executor; all others meet their counts in joins, so a small cache lets every size take both ways.
VOCABULARY = 1 << 16
CUT = 5
#: Training tokens a partition of the pair table, at most about; a task holds one partition.
PART = 16_000_000
#: Tokens that are sorted and sent together.
CHUNK = 2_000_000
START, END, UNKNOWN, FIRST = 0, 1, 2, 3
END_HASH = -1
#: Hashes keep out of the range of ids.
IDS = 1 << 32
PAIRS = "part int, keys binary, n binary, h binary, w binary, m binary"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of a batch, the word number of every token, and each text's number of words."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    flat = pc.list_flatten(words)
    full = pc.not_equal(pc.binary_length(flat), 0)
    lengths = np.bincount(pc.list_parent_indices(words).to_numpy()[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    coded = flat.filter(full).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], dtype=np.uint64).view(np.int64)
    return np.where((hashes >= END_HASH) & (hashes < IDS), hashes + 2 * IDS, hashes), coded.indices.to_numpy().astype(np.int64), lengths


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def word_counts(training: DataFrame) -> DataFrame:
    """hash, n of every word of the training documents, and of the end token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, codes, _ = tokens(b.column("text"))
            hashes, n = np.append(hashes, END_HASH), np.append(np.bincount(codes, minlength=len(hashes)), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["hash", "n"])

    return texts_of(training).mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def discounts(counts: dict[int, int]) -> np.ndarray:
    """d_r for r up to CUT from the counts of counts; 1 where the estimate isn't between 0 and 1, and at most 0.9 for r = 1."""
    n = [0, *(counts.get(r, 0) for r in range(1, CUT + 2))]
    d = np.ones(CUT + 1)
    if n[1]:
        share = (CUT + 1) * n[CUT + 1] / n[1]
        for r in range(1, CUT + 1):
            if n[r] and share != 1:
                found = ((r + 1) * n[r + 1] / n[r] / r - share) / (1 - share)
                d[r] = found if 0 < found <= 1 else 1.0
    d[1] = min(d[1], 0.9)
    return d


class Words:
    """Ids, counts and probabilities of the cached words; ``kept`` is the discounted count of all words."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray, total: int, ends: int, d: np.ndarray, kept: float):
        order = np.argsort(hashes)
        self.hashes, self.total, self.ends = hashes[order], total, ends
        self.n = np.concatenate([[0, ends, 0], n[order]]).astype(np.float64)
        self.d = np.append(d, 1.0)
        self.whole = total if kept < total - 1e-9 else total + 0.5
        self.p = self.n * self.d[np.minimum(self.n, CUT + 1).astype(int)] / self.whole
        self.unknown = self.p[UNKNOWN] = 1 - kept / self.whole
        self.hot = np.zeros(len(self.n), bool)

    @property
    def size(self) -> int:
        return len(self.n)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), UNKNOWN)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + FIRST, UNKNOWN)

    def cached(self, codes: np.ndarray) -> np.ndarray:
        return (codes >= 0) & (codes < self.size)

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """
        Every token, its end token included, after its history: the keys of pairs of cached words and the numbers of their
        texts, and history, word (ids, or hashes of words outside the cache) and text of all other pairs.
        """
        hashes, codes, lengths = tokens(texts)
        end = END if self.ends else UNKNOWN
        w = np.full(len(codes) + len(lengths), end)
        text = np.repeat(np.arange(len(lengths)), lengths + 1)
        last = np.cumsum(lengths + 1) - 1
        inner = np.ones(len(w), bool)
        inner[last] = False
        ids = self.ids(hashes)
        w[inner] = np.where(ids == UNKNOWN, hashes, ids)[codes] if len(hashes) else 0
        h = np.empty_like(w)
        h[1:] = w[:-1]
        h[np.cumsum(lengths + 1) - lengths - 1] = START
        known = self.cached(w)
        both = known & self.cached(h)
        if both.all():
            none = np.zeros(0, np.int64)
            return h * self.size + w, text, none, none, none
        return h[both] * self.size + w[both], text[both], h[~both], w[~both], text[~both]

    def log_p(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log10(self.p)

    def probability(self, n: Column) -> Column:
        """Of a word with so many training tokens, or null."""
        d = F.element_at(F.array(*(F.lit(float(x)) for x in self.d)), F.least(n, F.lit(CUT + 1)).cast("int") + 1)
        return F.when(n > 0, n * d / F.lit(float(self.whole))).otherwise(F.lit(float(self.unknown)))

    def parts(self, keys: np.ndarray, n: int) -> np.ndarray:
        h = keys // self.size
        return self.deal(np.where(self.hot[h], keys, -h - 1), n)

    def parts_of(self, h: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
        """As ``parts``, for pairs with a word outside the cache."""
        hot = self.is_hot(h)
        return self.deal(np.where(hot, w ^ mix64(h.view(np.uint64)).view(np.int64), -h - 1), n)

    def is_hot(self, h: np.ndarray) -> np.ndarray:
        known = self.cached(h)
        return known & self.hot[np.where(known, h, 0)]

    @staticmethod
    def deal(x: np.ndarray, n: int) -> np.ndarray:
        x = mix64(x.astype(np.int64).view(np.uint64))
        return ((x >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Little-endian numbers, byte by byte of equal weight, compressed."""
    x = np.ascontiguousarray(x)
    return len(x).to_bytes(8, "little") + pa.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), "zstd", asbytes=True) if len(x) else b""


def unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data[8:], n * width, "zstd"), np.uint8).reshape(width, n).T).view(kind).ravel()


def steps(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=0))


def unsteps(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int64))


def dealt(blocks: DataFrame, parts: int) -> DataFrame:
    """One task a partition of the model: the ids are the partition numbers."""
    return blocks.repartitionById(parts, F.col("part"))


def counted(h: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs in order, and their summed counts."""
    order = np.lexsort((w, h))
    h, w, n = h[order], w[order], n[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    return h[first], w[first], np.add.reduceat(n, first) if len(first) else n[:0]


def batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)


class Model:
    """
    Words, the folder with the table of pairs, one packed row a partition: keys and counts of pairs of cached words, then history,
    word and count of all others; and the folder with what words outside the cache add to the histories' seen probability.
    """

    def __init__(self, words, folder: str, seen: str, parts: int, d: np.ndarray, hot: dict[int, tuple[float, float]]):
        self.words, self.folder, self.seen, self.parts, self.d, self.hot = words, folder, seen, parts, d, hot


def unrow(keys: bytes, n: bytes, h: bytes, w: bytes, m: bytes) -> tuple[np.ndarray, ...]:
    return unsteps(keys), unpacked(n, np.int64), unsteps(h), unpacked(w, np.int64), unpacked(m, np.int64)


def rows_of(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    for row in zip(*(b.column(c).to_pylist() for c in ("keys", "n", "h", "w", "m")), strict=True):
        yield unrow(*row)


def count_pairs(training: DataFrame, words, parts: int) -> str:
    """Counts the pairs and writes the table; returns its folder."""
    names, kinds = ["part", "keys", "n", "h", "w", "m"], [pa.int32(), *[pa.binary()] * 5]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = words.value

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([x[0] for x in held]), return_counts=True)
            h, w = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            h, w, more = counted(h, w, np.ones(len(h), np.int64))
            part, part2 = m.parts(keys, parts), m.parts_of(h, w, parts)
            order, order2 = np.argsort(part, kind="stable"), np.argsort(part2, kind="stable")
            keys, n, h, w, more = keys[order], n[order].astype(np.int64), h[order2], w[order2], more[order2]
            at, at2 = (np.searchsorted(x, np.arange(parts + 1)) for x in (part[order], part2[order2]))
            rows = []
            for i in np.flatnonzero(np.diff(at) + np.diff(at2)):
                a, b = slice(at[i], at[i + 1]), slice(at2[i], at2[i + 1])
                rows.append((i, steps(keys[a]), packed(n[a]), steps(h[b]), packed(w[b]), packed(more[b])))
            return batch(rows, names, kinds)

        held, size = [], 0
        for b in batches:
            keys, _, h, w, _ = m.pairs(b.column("text"))
            held.append((keys, h, w))
            size += len(keys) + len(h)
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, h, w, m = (np.zeros(0, np.int64) for _ in range(5))
        part = 0
        held: list[tuple[np.ndarray, ...]] = []

        def join() -> tuple[np.ndarray, ...]:
            k, c = np.concatenate([keys, *(x[0] for x in held)]), np.concatenate([n, *(x[1] for x in held)])
            order = np.argsort(k, kind="stable")
            k, c = k[order], c[order]
            first = np.flatnonzero(np.diff(k, prepend=-1))
            more = (np.concatenate([old, *(x[i] for x in held)]) for i, old in ((2, h), (3, w), (4, m)))
            return k[first], np.add.reduceat(c, first) if len(first) else c[:0], *counted(*more)

        for b in batches:
            for part, *row in zip(*(x.to_pylist() for x in b.columns), strict=True):
                held.append(unrow(*row))
                if sum(len(x[0]) + len(x[2]) for x in held) > max(CHUNK, len(keys) + len(h)):
                    keys, n, h, w, m = join()
                    held = []
        if held or len(keys) + len(h):
            keys, n, h, w, m = join()
            yield batch([(part, steps(keys), packed(n), steps(h), packed(w), packed(m))], names, kinds)

    sent = texts_of(training).mapInArrow(send, PAIRS)
    folder = scratch(training.sparkSession, "pairs")
    dealt(sent, parts).mapInArrow(add, PAIRS).write.partitionBy("part").parquet(folder)
    return folder


def pair_table(model: Model, spark) -> DataFrame:
    """The model's pairs as rows: history, word (ids, or hashes of words outside the cache), n."""
    size = model.words.size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, n, h, w, m in rows_of(b):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((k // size, h), (k % size, w), (n, m))], ["history", "word", "n"])

    return spark.read.schema(PAIRS).parquet(model.folder).drop("part").mapInArrow(rows, "history long, word long, n long")


def history_sums(row: tuple[np.ndarray, ...], words: Words, d: np.ndarray, hot: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each history (or each hot one) in order: count, discounted count, and the single-word probability of the cached words seen after it."""
    keys, n, h, w, m = row
    if hot:
        some, more = words.hot[keys // words.size], words.is_hot(h)
        keys, n, h, w, m = keys[some], n[some], h[more], w[more], m[more]
    p = words.p[keys % words.size]
    known = words.cached(w)
    h, n, p = np.concatenate([keys // words.size, h]), np.concatenate([n, m]), np.concatenate([p, np.where(known, words.p[np.where(known, w, 0)], 0.0)])
    if len(w):
        order = np.argsort(h, kind="stable")
        h, n, p = h[order], n[order], p[order]
    if not len(h):
        return h, np.zeros(0), np.zeros(0), np.zeros(0)
    first = np.append(0, np.flatnonzero(h[1:] != h[:-1]) + 1)
    c = n * d[np.minimum(n, CUT + 1)]
    return h[first], np.add.reduceat(n.astype(float), first), np.add.reduceat(c, first), np.add.reduceat(p, first)


def shares(count: np.ndarray, discounted: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The divisor of a history's counts and its backoff weight."""
    rest = 1 - seen
    full = rest <= 1e-12  # every word was seen after it: nothing to back off to
    whole = np.where(full, discounted, np.where(discounted < count - 1e-9, count, count + 0.5))
    with np.errstate(divide="ignore", invalid="ignore"):
        return whole, np.where(full, 0.0, (1 - discounted / whole) / np.where(full, 1.0, rest))


def fit(docs: DataFrame, vocabulary: int = VOCABULARY) -> tuple[Model, DataFrame]:
    """The model from the training documents, and the counts of all words (hash, n)."""
    spark = docs.sparkSession
    bound_batches(spark)
    training = docs.where(~held_out(F.col("doc_id"))).select("text")
    counts = cut(word_counts(training), "words")
    of_counts = {int(r.n): r["count"] for r in counts.where(f"n <= {CUT + 1}").groupBy("n").count().collect()}
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = counts.where(f"hash = {END_HASH}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.where(f"hash <> {END_HASH}").orderBy(F.desc("n"), "hash").limit(vocabulary).toArrow()  # the cache
    d = discounts(of_counts)
    kept = total - sum((1 - float(d[r])) * r * of_counts.get(r, 0) for r in range(1, CUT + 1))
    words = Words(top.column("hash").to_numpy(), top.column("n").to_numpy(), total, ends, d, kept)
    parts = max(partitions(spark), -(-total // PART))
    words.hot = words.n * 4 * parts > max(total, 1)  # fewer than 4 x parts words
    held = spark.sparkContext.broadcast(words)
    folder = count_pairs(training, held, parts)
    table = spark.read.schema(PAIRS).parquet(folder)

    def counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, m in zip(b.column("n").to_pylist(), b.column("m").to_pylist(), strict=True):
                r = np.bincount(np.minimum(np.concatenate([unpacked(n, np.int64), unpacked(m, np.int64)]), CUT + 2), minlength=CUT + 3)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(CUT + 3)), pa.array(r)], ["r", "n"])

    found = table.select("n", "m").mapInArrow(counts_of_counts, "r long, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    d = np.append(discounts({r.r: r.n for r in found if r.r <= CUT + 1}), 1.0)

    def uncached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        for b in batches:
            for part, h, w in zip(*(b.column(c).to_pylist() for c in ("part", "h", "w")), strict=True):
                h, w = unsteps(h), unpacked(w, np.int64)
                rare = ~words.cached(w)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rare.sum(), part, np.int32)), pa.array(h[rare]), pa.array(w[rare])], ["part", "h", "hash"])

    seen = table.select("part", "h", "w").mapInArrow(uncached, "part int, h long, hash long").join(counts, "hash")
    seen = seen.groupBy("part", "h").agg(F.sum(words.probability(F.col("n"))).alias("seen"))
    seen_folder = scratch(spark, "seen")
    dealt(seen, parts).write.partitionBy("part").parquet(seen_folder)
    seen = spark.read.schema("h long, seen double, part int").parquet(seen_folder)

    def hot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in rows_of(b):
                h, *sums = history_sums(row, held.value, d, hot=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), *(pa.array(x) for x in sums)], ["h", "count", "discounted", "seen"])

    rows = table.drop("part").mapInArrow(hot_sums, "h long, count double, discounted double, seen double")
    rows = rows.unionByName(seen.where(F.col("h").isin(np.flatnonzero(words.hot).tolist())).select("h", F.lit(0.0).alias("count"), F.lit(0.0).alias("discounted"), "seen"))
    rows = rows.groupBy("h").agg(*(F.sum(c).alias(c) for c in ("count", "discounted", "seen"))).collect()  # the hot histories
    hot = {r.h: tuple(float(x[0]) for x in shares(*(np.array([r[c]]) for c in ("count", "discounted", "seen")))) for r in rows}
    return Model(words, folder, seen_folder, parts, d, hot), counts


def text_hash(texts: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in texts.cast(pa.large_binary()).to_pylist()], dtype=np.uint64).view(np.int64)


def evaluate(docs: DataFrame, model: Model) -> DataFrame:
    """key (the text's hash), score without the words in ``rare``, and ``rare``: hashes of words outside the cache that were backed off to."""
    spark = docs.sparkSession
    held, parts, folder, seen_folder = spark.sparkContext.broadcast((model.words, model.d, model.hot)), model.parts, model.folder, model.seen
    names, kinds = ["part", "chunk", "ids", "keys", "texts", "h", "w", "texts2"], [pa.int32(), pa.int64(), *[pa.binary()] * 6]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value[0]
        seen: set[int] = set()
        number = 0

        def flush() -> pa.RecordBatch:
            # a text's words are spread over the partitions; its hash travels once with a block's documents
            keys, text, h, w, text2 = (np.concatenate([x[i] for x in got]) for i in range(5))
            part, part2 = m.parts(keys, parts), m.parts_of(h, w, parts)
            order, order2 = np.argsort((part << 42) | keys, kind="stable"), np.lexsort((h, part2))
            keys, text, part = keys[order], text[order].astype(np.int32), part[order]
            h, w, text2, part2 = h[order2], w[order2], text2[order2].astype(np.int32), part2[order2]
            at, at2 = (np.searchsorted(x, np.arange(parts + 1)) for x in (part, part2))
            chunk = (TaskContext.get().partitionId() << 32) + number
            rows = [(number % parts, chunk, packed(np.array(ids, dtype=np.int64)), *[None] * 5)]
            for i in np.flatnonzero(np.diff(at) + np.diff(at2)):
                a, b = slice(at[i], at[i + 1]), slice(at2[i], at2[i + 1])
                rows.append((i, chunk, None, steps(keys[a]), packed(text[a]), steps(h[b]), packed(w[b]), packed(text2[b])))
            return batch(rows, names, kinds)

        got, ids, n = [], [], 0
        for b in batches:
            new = []
            for i, x in enumerate(text_hash(b.column("text")).tolist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
                    ids.append(x)
            keys, text, h, w, text2 = m.pairs(b.column("text").take(pa.array(new, pa.int64())))
            got.append((keys, text + len(ids) - len(new), h, w, text2 + len(ids) - len(new)))
            n += len(keys) + len(h)
            if n >= CHUNK:
                yield flush()
                got, ids, n, number = [], [], 0, number + 1
        if n:
            yield flush()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, d, hot = held.value
        table, log_p = None, m.log_p()
        for b in batches:
            out = []
            for part, chunk, ids, keys, texts, h, w, texts2 in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if ids is not None:
                    out.append((chunk, ids, None, None, None))
                    continue
                if table is None:
                    table = Pairs(folder, seen_folder, part, m, d, hot)
                texts, w, texts2 = unpacked(texts, np.int32), unpacked(w, np.int64), unpacked(texts2, np.int32)
                found, rare = table.log10_of(unsteps(h), w, log_p)
                sums = np.bincount(np.concatenate([texts, texts2]), weights=np.concatenate([table.log10(unsteps(keys), log_p), found]))
                out.append((chunk, None, packed(sums), packed(texts2[rare]), packed(w[rare])))
            yield batch(out, ["chunk", "ids", "sums", "texts", "rare"], [pa.int64(), *[pa.binary()] * 4])

    def total(rows: pa.Table) -> pa.Table:
        ids = np.concatenate([unpacked(x, np.int64) for x in rows.column("ids").to_pylist() if x is not None])
        sums = np.zeros(len(ids))
        for x in rows.column("sums").to_pylist():
            if x is not None:
                x = unpacked(x, np.float64)
                sums[: len(x)] += x
        text, rare = (np.concatenate([np.zeros(0, t), *(unpacked(x, t) for x in rows.column(c).to_pylist() if x)]) for c, t in (("texts", np.int32), ("rare", np.int64)))
        order = np.lexsort((rare, text))
        at = np.searchsorted(text[order], np.arange(len(ids) + 1)).astype(np.int32)
        return pa.table({"key": pa.array(ids), "score": pa.array(sums), "rare": pa.ListArray.from_arrays(pa.array(at), pa.array(rare[order]))})

    sent = texts_of(docs).mapInArrow(send, "part int, chunk long, ids binary, keys binary, texts binary, h binary, w binary, texts2 binary")
    sums = dealt(sent, parts).mapInArrow(look, "chunk long, ids binary, sums binary, texts binary, rare binary")
    rows = sums.groupBy("chunk").applyInArrow(total, "key long, score double, rare array<long>")
    return rows.groupBy("key").agg(F.min(F.struct("score", "rare")).alias("x")).select("key", "x.score", "x.rare")


class Pairs:
    """One partition of the pair table, in memory."""

    def __init__(self, folder: str, seen_folder: str, part: int, words: Words, d: np.ndarray, hot: dict[int, tuple[float, float]]):
        def read(folder: str, columns: list[str]) -> pa.Table | None:
            system, root = file_system(folder)
            path = f"{root}/part={part}"
            if system.get_file_info(path).type.name == "Directory":
                return pads.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=False).to_table(columns=columns)
            return None

        self.words, self.d = words, d
        row = tuple(np.zeros(0, np.int64) for _ in range(5))
        t = read(folder, ["keys", "n", "h", "w", "m"])
        if t is not None and t.num_rows:
            row = unrow(*(t.column(c)[0].as_py() for c in t.column_names))
        self.keys, self.n = row[:2]
        h, *sums = history_sums(row, words, d)
        t = read(seen_folder, ["h", "seen"])
        if t is not None and t.num_rows:
            sums[2][np.searchsorted(h, t.column("h").to_numpy())] += t.column("seen").to_numpy()
        # pairs with a word outside the cache, in order, known by the places of their history and word
        self.h2, self.w2, self.n2 = np.unique(row[2]), np.unique(row[3]), row[4]
        self.keys2 = np.searchsorted(self.h2, row[2]) * len(self.w2) + np.searchsorted(self.w2, row[3])
        whole, alpha = shares(*sums)
        self.h = np.array(sorted({*h.tolist(), *hot}), dtype=np.int64)
        self.whole, self.alpha = np.ones(len(self.h)), np.ones(len(self.h))
        at = np.searchsorted(self.h, h)
        self.whole[at], self.alpha[at] = whole, alpha
        for x, (a, b) in hot.items():
            i = np.searchsorted(self.h, x)
            self.whole[i], self.alpha[i] = a, b

    def log10(self, keys: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Of each pair: from its own count, or else from its word's with the history's backoff weight."""
        h, w = keys // self.words.size, keys % self.words.size
        if not len(self.h):
            return log_p[w]
        i = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        known = self.h[i] == h
        alpha, whole = np.where(known, self.alpha[i], 1.0), np.where(known, self.whole[i], 1.0)
        if not len(self.keys):
            return np.log10(alpha) + log_p[w]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        n = np.where(self.keys[at] == keys, self.n[at], 0)
        with np.errstate(divide="ignore"):
            return np.where(n > 0, np.log10(np.maximum(n, 1) * self.d[np.minimum(n, CUT + 1)] / whole), np.log10(alpha) + log_p[w])

    def log10_of(self, h: np.ndarray, w: np.ndarray, log_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``log10``, for pairs with a word outside the cache; and which of them still lack the probability of their word."""
        alpha, whole, n = np.ones(len(h)), np.ones(len(h)), np.zeros(len(h), np.int64)
        if len(self.h):
            i = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            known = self.h[i] == h
            alpha, whole = np.where(known, self.alpha[i], 1.0), np.where(known, self.whole[i], 1.0)
        if len(self.keys2):
            i, j = np.minimum(np.searchsorted(self.h2, h), len(self.h2) - 1), np.minimum(np.searchsorted(self.w2, w), len(self.w2) - 1)
            keys = i * len(self.w2) + j
            at = np.minimum(np.searchsorted(self.keys2, keys), len(self.keys2) - 1)
            n = np.where((self.h2[i] == h) & (self.w2[j] == w) & (self.keys2[at] == keys), self.n2[at], 0)
        cached = self.words.cached(w)
        with np.errstate(divide="ignore"):
            back = np.log10(alpha) + np.where(cached, log_p[np.where(cached, w, 0)], 0.0)
            return np.where(n > 0, np.log10(np.maximum(n, 1) * self.d[np.minimum(n, CUT + 1)] / whole), back), (n == 0) & ~cached


def score(docs: DataFrame, vocabulary: int = VOCABULARY, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Pairs (order 2) travel packed, as this module says; other orders are joined, by ``katz_orders``."""
    if order != 2:
        from tickspark.llm import katz_orders

        return katz_orders.score(docs, order)
    spark = docs.sparkSession
    model, counts = fit(docs, vocabulary)
    types = counts.count()
    total = model.words.total
    held = spark.sparkContext.broadcast(model.words)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = held.value, set()
        log_n = np.log10(m.n + 0.5)
        for b in batches:
            hashes, codes, lengths = tokens(b.column("text"))
            keys = text_hash(b.column("text"))
            ids = m.ids(hashes)[codes] if len(hashes) else codes
            top, at = ids != UNKNOWN, np.append(0, np.cumsum(lengths))
            of = np.repeat(np.arange(len(lengths)), lengths)
            known = np.bincount(of, weights=top, minlength=len(lengths)).astype(np.int64) + (m.ends > 0)
            base = np.bincount(of, weights=np.where(top, log_n[ids], 0), minlength=len(lengths)) + log_n[END]
            rare = []
            for i, k in enumerate(keys.tolist()):
                rare.append(hashes[codes[at[i] : at[i + 1]][~top[at[i] : at[i + 1]]]] if k not in seen else [])
                seen.add(k)
            part = np.full(len(keys), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(keys), pa.array(part), pa.array(lengths + 1), pa.array(known), pa.array(base), pa.array(rare, pa.list_(pa.int64()))], ["doc_id", "key", "task", "n_tokens", "known", "base", "rare"])

    rows = cut(texts_of(docs, F.col("doc_id")).select("doc_id", "text").mapInArrow(local, "doc_id long, key long, task int, n_tokens long, known long, base double, rare array<long>"), "local")
    # words outside the cache meet the counts of all words; a text that several tasks have read is summed in each
    rare = rows.where("size(rare) > 0").select("key", "task", F.explode("rare").alias("hash")).groupBy("key", "task", "hash").agg(F.count("*").alias("m"))
    rare = rare.join(counts, "hash", "left").groupBy("key", "task").agg(F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("known2"), F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("base2"))
    rare = rare.groupBy("key").agg(F.min("known2").alias("known2"), F.min("base2").alias("base2"))
    scores = cut(evaluate(docs, model), "scores")
    back = scores.where("size(rare) > 0").select("key", F.explode("rare").alias("hash")).groupBy("key", "hash").agg(F.count("*").alias("m")).join(counts, "hash", "left")
    back = back.groupBy("key").agg(F.sum(F.col("m") * F.log10(model.words.probability(F.col("n")))).alias("back"))
    texts = scores.drop("rare").join(rare, "key", "left").join(back, "key", "left")
    less = F.log10(F.lit(float(total)) + 0.5 * (types + 1))
    return rows.join(texts, "key").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) - F.col("n_tokens") * less).alias("base_score"), (F.col("score") + F.coalesce("back", F.lit(0.0))).alias("score"),
    )
