"""Quality classifier from weak labels.

Heuristic labellers vote good (1), junk (0) or not at all (-1) on every document. How often each pattern of votes occurs is
counted over all documents; expectation-maximisation on these counts estimates the share of good documents and how each
labeller votes on good and on junk, so overlapping labellers get the weight that their agreement earns. The posterior of each
pattern is the label that a hashed linear scorer is fitted to, on at most ``examples`` documents (those whose ids hash
lowest: the documented bound of the fit). The scorer then scores every document, also where the labellers are silent.

``votes_of`` and ``features`` say what a text's votes and features are; tasks compute the same for whole batches (``Batch``),
where each distinct word is looked at once.

Defined cases: a null or empty text has no votes and the score of the bias; rows and ids may repeat, and of an id's texts the one
with the smallest digest may be an example; a null doc_id is scored but never an example; without documents the scorer is 0
and keeps everything; other columns are kept, and a column named like an output is replaced.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut, free

EXAMPLES = 8000
WIDTH = 1 << 18
KEEP = 0.4
SHAPE = bytes(120 if 97 <= b <= 122 or b >= 128 else 88 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else b for b in range(256))
UPPER, DIGITS, SPACES = (bytes(b for b in range(256) if SHAPE[b] == c) for c in b"X9 ")
SPACES += b"\t\n\r\x0b\x0c"
LOWER = bytes(b for b in range(256) if SHAPE[b] == 120)
WORDY = UPPER + LOWER + DIGITS
RUNS = re.compile(rb"(.)\1+", re.DOTALL)
NUL = zlib.crc32(b"\0")


def vote(junk: bool, good: bool) -> int:
    return 0 if junk else 1 if good else -1


def number_of(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def votes_of(text: bytes | None) -> list[int]:
    """One vote a labeller: repetition, variety, symbols, capitals, wordless tokens, sentence marks, word length, digits, echoes."""
    w = text.split() if text else []
    n = len(w)
    if n < 8:
        return [-1] * 9
    counts = Counter(w)
    size = len(text) - number_of(text, SPACES)
    upper, digit = number_of(text, UPPER) / size, number_of(text, DIGITS) / size
    symbols = 1 - number_of(text, WORDY) / size
    top, variety = max(counts.values()) / n, len(counts) / n
    bare = sum(m for x, m in counts.items() if x.translate(None, WORDY) == x) / n
    marks = sum(m for x, m in counts.items() if x[-1] in b".,;:!?") / n
    length = size / n
    echo = sum(a == b for a, b in zip(w, w[1:])) / n  # noqa: B905
    return [
        vote(top > 0.25, top < 0.15),
        vote(variety < 0.35 and n < 3000, variety > 0.5),
        vote(symbols > 0.08, symbols < 0.05),
        vote(upper > 0.3, upper < 0.1),
        vote(bare > 0.1, bare < 0.02),
        vote(marks < 0.02 or marks > 0.6, 0.05 < marks < 0.3),
        vote(length < 2.5 or length > 9, 3.5 < length < 7.5),
        vote(digit > 0.2, digit < 0.05),
        vote(echo > 0.2, echo < 0.1),
    ]


def table_of(some: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(some))


class Batch:
    """The words of many texts: each distinct word's bytes are looked at once."""

    def __init__(self, texts: pd.Series):
        flat = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).fill_null(b"").view(pa.large_string()))
        of, words = pc.list_parent_indices(flat).to_numpy(), pc.list_flatten(flat)
        full = pc.not_equal(pc.binary_length(words), 0)
        coded = words.filter(full).dictionary_encode()
        of, self.codes = of[full.to_numpy(zero_copy_only=False)].astype(np.int64), coded.indices.to_numpy().astype(np.int64)
        self.size, kinds = len(texts), coded.dictionary.cast(pa.large_binary())
        self.data = np.frombuffer(kinds.buffers()[2] or b"", np.uint8)
        self.at = np.frombuffer(kinds.buffers()[1], np.int64)[kinds.offset : kinds.offset + len(kinds) + 1] if len(kinds) else np.zeros(1, np.int64)
        self.of, self.n = of, np.bincount(of, minlength=self.size)
        # each text's different words and how often it has them
        order = np.lexsort((self.codes, of))
        key = of[order] * max(len(kinds), 1) + self.codes[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.text, self.word, self.times = of[order][first], self.codes[order][first], np.diff(np.append(first, len(key)))
        self.most = np.zeros(self.size, np.int64)
        np.maximum.at(self.most, self.text, self.times)

    def sum(self, x: np.ndarray) -> np.ndarray:
        """Of a number for each distinct word, over each text's words."""
        return np.bincount(self.of, weights=x[self.codes], minlength=self.size) if len(self.codes) else np.zeros(self.size)

    def bytes_in(self, some: np.ndarray) -> np.ndarray:
        """How many bytes of each distinct word are among ``some``."""
        total = np.append(0, np.cumsum(some[self.data]))
        return total[self.at[1:]] - total[self.at[:-1]]

    def votes(self) -> list[str]:
        """As ``votes_of``; one letter a labeller, g, j or a dot."""
        wordy = self.bytes_in(table_of(WORDY))
        ends = table_of(b".,;:!?")[self.data[self.at[1:] - 1]] if len(self.at) > 1 else np.zeros(0)
        same = (self.codes[1:] == self.codes[:-1]) & (self.of[1:] == self.of[:-1])
        n = np.maximum(self.n, 1)
        size = np.maximum(self.sum(np.diff(self.at)), 1)
        top, variety = self.most / n, np.bincount(self.text, minlength=self.size) / n
        symbols, upper, digit = 1 - self.sum(wordy) / size, self.sum(self.bytes_in(table_of(UPPER))) / size, self.sum(self.bytes_in(table_of(DIGITS))) / size
        bare, marks, length = self.sum(wordy == 0) / n, self.sum(ends) / n, size / n
        echo = np.bincount(self.of[1:][same], minlength=self.size) / n
        said = [
            (top > 0.25, top < 0.15),
            ((variety < 0.35) & (self.n < 3000), variety > 0.5),
            (symbols > 0.08, symbols < 0.05),
            (upper > 0.3, upper < 0.1),
            (bare > 0.1, bare < 0.02),
            ((marks < 0.02) | (marks > 0.6), (0.05 < marks) & (marks < 0.3)),
            ((length < 2.5) | (length > 9), (3.5 < length) & (length < 7.5)),
            (digit > 0.2, digit < 0.05),
            (echo > 0.2, echo < 0.1),
        ]
        letters = np.stack([np.where(junk, ord("j"), np.where(good, ord("g"), ord("."))) for junk, good in said], 1).astype(np.uint8)
        letters[self.n < 8] = ord(".")
        return [row.tobytes().decode() for row in letters]

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Each text's ``features`` times the weights, and the bias."""
        raw, shape = self.data.tobytes(), np.frombuffer(SHAPE, np.uint8)[self.data]
        starts = np.zeros(len(shape), bool)
        starts[self.at[:-1]] = True
        kept = starts | (np.diff(shape, prepend=0) != 0)  # of equal neighbours in a word, one
        shape, ends = shape[kept].tobytes(), np.append(0, np.cumsum(kept))[self.at]
        at = self.at.tolist()
        word = np.array([zlib.crc32(raw[a:b]) % WIDTH for a, b in itertools.pairwise(at)], np.int64)
        form = np.array([zlib.crc32(shape[a:b], NUL) % WIDTH for a, b in itertools.pairwise(ends.tolist())], np.int64)
        some = np.flatnonzero(self.n)
        share = np.array([zlib.crc32(b"\1%d" % int(10 * (m / n))) % WIDTH for m, n in zip(self.most[some].tolist(), self.n[some].tolist(), strict=True)], np.int64)
        keys = np.concatenate([self.text * WIDTH + word[self.word], self.text * WIDTH + form[self.word], some * WIDTH + share]) if len(some) else np.zeros(0, np.int64)
        times = np.concatenate([self.times, self.times, 2 * self.n[some]]).astype(float)
        order = np.argsort(keys)
        first = np.flatnonzero(np.diff(keys[order], prepend=-1))
        total = np.add.reduceat(times[order], first) if len(first) else times
        text, bucket = np.divmod(keys[order][first], WIDTH)
        length = np.sqrt(np.bincount(text, weights=total * total, minlength=self.size))
        return np.bincount(text, weights=total * weights[bucket], minlength=self.size) / np.where(length > 0, length, 1) + weights[WIDTH]


def with_votes(docs: DataFrame) -> DataFrame:
    """``docs`` with _votes: one letter a labeller, g, j or a dot."""

    @F.pandas_udf("string")
    def label(texts: pd.Series) -> pd.Series:
        return pd.Series(Batch(texts).votes(), dtype=object)

    return docs.withColumn("_votes", label(F.col("text").cast("binary")))


class LabelModel:
    """Shares of good documents and of each labeller's votes, from the counts of vote patterns (at most 3^9)."""

    def __init__(self, patterns: dict[str, int], rounds: int = 100):
        names = sorted(patterns)
        self.posterior: dict[str, float] = {}
        if not names:
            return
        v = np.array([["jg.".index(c) for c in p] for p in names])
        n = np.array([patterns[p] for p in names], float)
        junk, good = (v == 0).sum(1), (v == 1).sum(1)
        # the start: a labeller that says junk is believed before those that see nothing wrong
        q = np.where(junk > 0, 0.5 / (junk + 0.5), np.where(good > 0, 0.95, 0.5))
        for _ in range(rounds):
            prior = ((q * n).sum() + 1) / (n.sum() + 2)
            ll = np.log([[1 - prior], [prior]]).repeat(len(names), 1)
            self.rates = np.zeros((2, v.shape[1], 3))
            for y, weight in ((0, (1 - q) * n), (1, q * n)):
                for k in range(v.shape[1]):
                    # a labeller's silence says nothing
                    c = np.bincount(v[:, k], weights=weight, minlength=3)[:2] + [1 + 2 * (y == 0), 1 + 2 * (y == 1)]
                    self.rates[y, k, :2] = c / c.sum()
                    self.rates[y, k, 2] = 1
                    ll[y] += np.log(self.rates[y, k, v[:, k]])
            new = 1 / (1 + np.exp(np.clip(ll[0] - ll[1], -50, 50)))
            if np.abs(new - q).max() < 1e-9:
                break
            q = new
        self.prior, self.posterior = float(prior), dict(zip(names, q.tolist(), strict=True))


@lru_cache(maxsize=1 << 17)
def buckets(w: bytes) -> tuple[int, int]:
    """Where a word and its shape are counted."""
    return zlib.crc32(w) % WIDTH, zlib.crc32(b"\0" + RUNS.sub(rb"\1", w.translate(SHAPE))) % WIDTH


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and shapes of words, and how much the commonest word repeats; of length 1 in all."""
    counts = Counter(text.split()) if text else Counter()
    total: Counter = Counter()
    for w, n in counts.items():
        word, shape = buckets(w)
        total[word] += n
        total[shape] += n
    if counts:
        share = max(counts.values()) / counts.total()
        total[zlib.crc32(b"\1%d" % int(10 * share)) % WIDTH] += 2 * counts.total()
    i, x = np.fromiter(total.keys(), np.int64, len(total)), np.fromiter(total.values(), np.float64, len(total))
    return i, x / np.sqrt((x * x).sum()) if len(x) else x


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 8, rate: float = 0.5) -> np.ndarray:
    """Logistic regression on probable labels, with step sizes that shrink by feature; the last weight is the bias."""
    w, g = np.zeros(WIDTH + 1), np.full(WIDTH + 1, 1e-6)
    for _, (i, x, y) in itertools.product(range(epochs), rows):
        i, x = np.append(i, WIDTH), np.append(x, 1.0)
        step = (y - 1 / (1 + np.exp(-np.clip(w[i] @ x, -50, 50)))) * x
        g[i] += step * step
        w[i] += rate * step / np.sqrt(g[i])
    return w


def fit(docs: DataFrame, examples: int = EXAMPLES) -> tuple[LabelModel, np.ndarray]:
    bound_batches(docs.sparkSession)
    name = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    voted = cut(with_votes(docs.select("doc_id", "text")).select("doc_id", name.alias("_of"), "_votes"), "votes")
    model = LabelModel({r["_votes"]: r["count"] for r in voted.groupBy("_votes").count().collect()})
    chosen = voted.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("_of", "_votes")).alias("_x"))
    chosen = cut(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples).select("doc_id", "_x.*"), "chosen")  # the bound of the sample

    def hash_(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = [features(t) for t in part["text"]]
            yield part[["doc_id", "_votes"]].assign(i=[i for i, _ in both], x=[x for _, x in both])

    rows = docs.select("doc_id", "text", name.alias("_of")).join(F.broadcast(chosen), ["doc_id", "_of"])
    rows = rows.groupBy("doc_id", "_of", "_votes").agg(F.first(F.coalesce("text", F.lit("")).cast("binary")).alias("text"))  # repeated rows are one example
    rows = rows.mapInPandas(hash_, "doc_id long, _votes string, i array<int>, x array<float>").toPandas()
    order = rows.assign(n=[len(i) for i in rows["i"]]).sort_values(["doc_id", "n"]).index
    order = np.random.default_rng(7).permutation(order)
    return model, train([(np.asarray(rows["i"][r], np.int64), np.asarray(rows["x"][r], float), model.posterior[rows["_votes"][r]]) for r in order])


def score(docs: DataFrame, model: LabelModel, weights: np.ndarray, keep: float = KEEP) -> DataFrame:
    """``docs`` with votes, posterior (of the labellers alone), score and keep."""
    held = docs.sparkSession.sparkContext.broadcast((model.posterior, weights))

    @F.pandas_udf("votes string, posterior double, score double")
    def look(texts: pd.Series) -> pd.DataFrame:
        posterior, w = held.value
        batch = Batch(texts)
        votes = batch.votes()
        score = 1 / (1 + np.exp(-np.clip(batch.dot(w), -50, 50)))
        return pd.DataFrame({"votes": votes, "posterior": [posterior.get(v) for v in votes], "score": score})

    q = free("_q", docs)
    out = docs.withColumn(q, look(F.col("text").cast("binary")))
    names: dict[str, Column] = {c: F.col(q)[c] for c in ("votes", "posterior", "score")}
    return out.withColumns(names | {"keep": F.col(q)["score"] >= keep}).drop(q)
