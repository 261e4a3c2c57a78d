"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine on a block-max inverted index.

The examples are a sample of the labelled training documents of at most ``examples`` rows, those whose ids hash lowest.
Terms are the words, and beginnings of words, that toxic examples have more often than chance would let them (a binomial test over groups of
near copies, so that a text with many copies counts once); how common a term is, is counted over all documents. The examples'
normalised vectors lie in postings that are cut into blocks of neighbouring examples, each with its largest weight. A query
adds these up to a bound for each block, visits blocks in falling order of their bounds and stops when no further block can
reach the k nearest found so far: exact, and most blocks are never opened.

Neighbours vote with their squared cosine. The share of toxic votes is calibrated on the examples themselves, each scored
without itself and its copies, by a monotone (pool-adjacent-violators) fit. A document without any term has no neighbours;
its score is the rate of toxic examples among those without terms.

Defined cases: null and empty texts have no terms; an id with several labels is toxic if one of them is; null labels and ids
teach nothing; without toxic examples every score is 0; of equally near examples those with the lowest hashes vote; rows and
ids may repeat, and of an id's texts the one with the smallest digest is the example; other columns are kept, and a column named like an output is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut, free
from tickspark.llm.decontaminate import BYTES

EXAMPLES = 8000
K = 15
THRESHOLD = 0.7
P_VALUE = 1e-5
BLOCK = 32
#: The least groups of near copies a term occurs in.
MIN_GROUPS = 4
#: The least share of toxic groups among those with a term.
PURITY = 0.8
SHORTEST, LONGEST = 4, 7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def words(text: str | None) -> list[str]:
    return text.lower().encode("utf-8", "replace").translate(BYTES).decode().split() if text else []


def group_of(w: list[str]) -> int:
    """The smallest hash of three consecutive words: near copies mostly agree on it."""
    return min((xxhash.xxh64_intdigest(" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))), default=0) >> 1


def terms_of(w: str) -> list[str]:
    """The word and, marked, its beginnings of 4 to 7 letters."""
    return [w, *(f"{w[:n]}*" for n in range(SHORTEST, min(len(w), LONGEST) + 1))]


def examples_of(docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """doc_id, toxic, h, group_id, words, counts of at most ``n`` training rows, those with the lowest hashes."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for i, toxic, h, text in zip(part["doc_id"], part["toxic"], part["h"], part["text"], strict=True):
                w = words(text)
                c = Counter(w)
                out.append((i, toxic, h, group_of(w), list(c), list(c.values())))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "h", "group_id", "words", "counts"])

    chosen = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(n)  # the bound of the sample
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "toxic", "h").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text"))  # one row an id
    return cut(rows.select("doc_id", "toxic", "h", "text").mapInPandas(count, "doc_id long, toxic int, h long, group_id long, words array<string>, counts array<int>"), "examples")


def upper_tail(k: int, n: int, p: float) -> float:
    """P(X >= k) for a binomial X."""
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k, n + 1))


def choose_terms(ex: DataFrame, p_value: float, min_groups: int) -> list[str]:
    """Terms that toxic groups of examples have too often for chance, and clean groups hardly ever."""
    groups = ex.groupBy("group_id").agg(F.max("toxic").alias("toxic"))
    rate = groups.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    w = F.col("w")
    begins = [F.when(F.length(w) >= n, F.concat(F.substring(w, 1, n), F.lit("*"))) for n in range(SHORTEST, LONGEST + 1)]
    each = ex.select("toxic", "group_id", F.explode("words").alias("w")).select("toxic", "group_id", F.explode(F.array_compact(F.array(w, *begins))).alias("term"))
    seen = each.groupBy("term", "group_id").agg(F.max("toxic").alias("t"), F.min("toxic").alias("c"))
    found = seen.groupBy("term").agg(F.sum("t").alias("a"), F.sum(1 - F.col("c")).alias("c")).where((F.col("a") >= min_groups) & (F.col("a") >= PURITY * (F.col("a") + F.col("c"))))
    return sorted(r.term for r in found.collect() if rate >= 1 or upper_tail(r.a, r.a + r.c, rate) < p_value)


def vectors_of(ex: DataFrame, terms: list[str]) -> pd.DataFrame:
    """The examples with their counts of the chosen terms, in the order of their hashes."""
    held = ex.sparkSession.sparkContext.broadcast(Vocabulary(terms))

    def choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [held.value.weigh(zip(w, n, strict=True)) for w, n in zip(part["words"], part["counts"], strict=True)]
            yield part[["doc_id", "toxic", "h", "group_id"]].assign(terms=[list(c) for c in found], counts=[list(c.values()) for c in found])

    rows = ex.mapInPandas(choose, "doc_id long, toxic int, h long, group_id long, terms array<string>, counts array<int>").toPandas()
    return rows.sort_values(["h", "doc_id", "group_id"], ignore_index=True)


class Vocabulary:
    """Finds the chosen terms in a text; the first letters of a word rule most words out."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.begins = {t[:SHORTEST].rstrip("*") for t in terms}

    def weigh(self, found: Iterable[tuple[str, int]]) -> Counter:
        total: Counter = Counter()
        for w, n in found:
            if w[:SHORTEST] in self.begins:
                for t in terms_of(w):
                    if t in self.number:
                        total[t] += n
        return total

    def counts(self, found: Iterable[str]) -> Counter:
        return self.weigh(Counter(w for w in found if w[:SHORTEST] in self.begins).items())


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those with each term; over all of them."""
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(terms))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = Counter(), 0
        for part in parts:
            for text in part["text"]:
                total.update(held.value.counts(words(text)).keys())
            n += len(part)
        yield pd.DataFrame({"term": [None, *total], "n": [n, *total.values()]})

    rows = docs.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = {r.term: r.n for r in rows}
    return n.pop(None, 0), n


class Neighbours:
    """The index over the examples' vectors. It is a few MB for 8000 examples and travels as a broadcast."""

    def __init__(self, terms: list[str], idf: np.ndarray, ex: pd.DataFrame, k: int):
        self.vocabulary, self.idf, self.k = Vocabulary(terms), idf, k
        self.number = self.vocabulary.number
        vectors = [self.vector(Counter(dict(zip(t, c, strict=True)))) for t, c in zip(ex["terms"], ex["counts"], strict=True)]
        have = [i for i, (t, _) in enumerate(vectors) if len(t)]
        none = [i for i, (t, _) in enumerate(vectors) if not len(t)]
        self.without = float((ex["toxic"].iloc[none].sum()) / (len(none) + 1)) if len(ex) else 0.0
        self.ids, self.toxic, self.groups = (ex[c].to_numpy()[have] for c in ("doc_id", "toxic", "group_id"))
        # an example's near copies stand together, which makes the blocks' largest weights tight
        order = np.argsort(np.array([vectors[i][0][vectors[i][1].argmax()] for i in have], dtype=np.int64), kind="stable") if have else np.zeros(0, int)
        self.ids, self.toxic, self.groups = self.ids[order], self.toxic[order], self.groups[order]
        vectors = [vectors[have[i]] for i in order]
        self.blocks = -(-len(vectors) // BLOCK)
        self.postings: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in terms]
        self.most = np.zeros((len(terms), self.blocks))
        for b in range(self.blocks):
            by_term: dict[int, list[tuple[int, float]]] = {}
            for i in range(b * BLOCK, min(len(vectors), (b + 1) * BLOCK)):
                for t, x in zip(*vectors[i], strict=True):
                    by_term.setdefault(int(t), []).append((i - b * BLOCK, float(x)))
            for t, found in by_term.items():
                self.postings[t].append((b, np.array([i for i, _ in found]), np.array([x for _, x in found])))
                self.most[t, b] = max(x for _, x in found)
        self.postings = [{b: (i, x) for b, i, x in p} for p in self.postings]
        self.steps, self.levels = np.zeros(0), np.zeros(0)
        self.calibrate(vectors)

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        t = np.array(sorted(self.number[w] for w in counts if w in self.number), dtype=np.int64)
        names = {self.number[w]: n for w, n in counts.items() if w in self.number}
        x = np.array([(1 + math.log(names[i])) * self.idf[i] for i in t])
        return t, x / np.sqrt((x * x).sum()) if len(x) else x

    def nearest(self, t: np.ndarray, x: np.ndarray, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above 0 and their cosines; ``but``: a group of copies to leave out."""
        bounds = x @ self.most[t] if len(t) else np.zeros(0)
        ids, cosines, least = np.zeros(0, int), np.zeros(0), 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(ids) == self.k and bounds[b] < least - 1e-12:
                break
            s = np.zeros(BLOCK)
            for i, w in zip(t, x, strict=True):
                if b in self.postings[i]:
                    at, weights = self.postings[i][b]
                    s[at] += w * weights
            i = np.flatnonzero(s > 0)
            if but is not None:
                i = i[self.groups[b * BLOCK + i] != but]
            ids, cosines = np.concatenate([ids, b * BLOCK + i]), np.concatenate([cosines, s[i]])
            keep = np.lexsort((ids, -np.round(cosines, 12)))[: self.k]
            ids, cosines = ids[keep], cosines[keep]
            least = cosines[-1] if len(ids) else 0.0
        return ids, cosines

    def vote(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        w = cosines**2
        return float((w * self.toxic[ids]).sum() / w.sum())

    def calibrate(self, vectors: list) -> None:
        """Pool adjacent violators over votes that leave the example and its copies out; two doubtful cases are added."""
        votes = [(self.vote(*found), int(y)) for (t, x), g, y in zip(vectors, self.groups, self.toxic, strict=True) if len((found := self.nearest(t, x, but=g))[0])]
        pools: list[list[float]] = []
        for v, y in sorted([*votes, (0.0, 1), (1.0, 0)]):
            pools.append([v, y, 1])
            while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                _, a, n = pools.pop()
                pools[-1][1] += a
                pools[-1][2] += n
        self.steps, self.levels = np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])

    def score(self, counts: Counter) -> tuple[float, list[int], list[float]]:
        ids, cosines = self.nearest(*self.vector(counts))
        if not len(ids):
            return self.without, [], []
        at = np.searchsorted(self.steps, self.vote(ids, cosines), "right") - 1
        return float(self.levels[max(at, 0)]), [int(i) for i in self.ids[ids]], [float(c) for c in cosines]


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, k: int = K, p_value: float = P_VALUE) -> Neighbours:
    bound_batches(docs.sparkSession)
    ex = examples_of(docs, labels, examples)
    terms = choose_terms(ex, p_value, MIN_GROUPS)
    n, df = document_frequencies(docs, terms)
    idf = np.array([math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in terms])
    return Neighbours(terms, idf, vectors_of(ex, terms), k)


def score(docs: DataFrame, model: Neighbours, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score, predicted, neighbours (ids) and cosines."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, neighbours array<long>, cosines array<double>")
    def look(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for texts in parts:
            yield pd.DataFrame([m.score(m.vocabulary.counts(words(t))) for t in texts], columns=["score", "neighbours", "cosines"])

    near = free("_near", docs)
    out, found = docs.withColumn(near, look("text")), F.col(near)
    return out.withColumns({"held_out": held_out(F.col("doc_id")), "score": found["score"], "predicted": (found["score"] >= threshold).cast("int"), "neighbours": found["neighbours"], "cosines": found["cosines"]}).drop(near)
