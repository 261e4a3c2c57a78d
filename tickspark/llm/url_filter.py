"""URL filter on a sorted digest array.

The rules (``host/path`` and an action) become one file: the 64-bit xxhash of every rule string in ascending order, the ends
of the strings, the actions and the strings themselves. Spark ships the file to every executor, whose Python workers map it
into memory and share its pages. The strings that could be a rule of a url (every domain its host lies in, with the prefixes
of its path that are as long as some rule's path) are hashed, found by a vectorised binary search, and confirmed against the
stored strings, so that equal digests of different strings never count.

The urls are never shuffled. A list above ``max_bytes`` is not shipped; its rules are joined with the same candidate strings
instead (``judge_by_join``), with the same result.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; an empty host fits none; of
several fitting rules the longest string wins, then the longer host; a rule listed with both actions blocks; null rules are
left out; rows and ids may repeat; the other columns of the input are kept, but a column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import ascii_lower, free, scratch

MAX_BYTES = 64 << 20
DEFAULT = "allow"
MAGIC = 0x5449434B55524C31


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    rest = F.coalesce(F.get(F.split(F.col(url), "://", 2), F.lit(1)), F.lit(""))
    return df.withColumns({"host": ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row a rule: the host in lower case, ``block`` before ``allow``."""
    host, path = F.regexp_extract("rule", r"^([^/]*)", 1), F.regexp_extract("rule", r"^[^/]*([\s\S]*)$", 1)
    return rules.where("rule is not null and action in ('allow', 'block')").groupBy(F.concat(ascii_lower(host), path).alias("rule")).agg(F.max("action").alias("action"))


@F.pandas_udf(T.LongType())
def digest(s: pd.Series) -> pd.Series:
    return pd.Series(np.array([xxhash.xxh64_intdigest(x) for x in s], dtype=np.uint64).view(np.int64))


class UrlIndex:
    """The shipped file; made by ``build``."""

    def __init__(self, name: str):
        self.name = name

    @staticmethod
    def build(rules: DataFrame, max_bytes: int = MAX_BYTES) -> UrlIndex | None:
        """None if the list is above ``max_bytes``, which Spark counts before anything is gathered."""
        spark = rules.sparkSession
        rules = clean_rules(rules)
        n, size = rules.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("rule") + 17), F.lit(0))).first()
        if size > max_bytes:
            return None
        rows = rules.select(digest("rule").alias("key"), F.col("rule").cast("binary").alias("rule"), (F.col("action") == "block").cast("byte").alias("block"))
        keys, ends, block, strings = np.empty(n, np.uint64), np.empty(n, np.uint64), np.empty(n, np.uint8), bytearray()
        lengths = set()
        # in unsigned order
        for i, r in enumerate(rows.orderBy(F.shiftrightunsigned("key", 1), F.col("key").bitwiseAND(F.lit(1)), "rule").toLocalIterator()):
            keys[i] = np.uint64(r.key & 0xFFFFFFFFFFFFFFFF)
            block[i] = r.block
            strings += r.rule
            ends[i] = len(strings)
            s = r.rule.decode()
            lengths.add(len(s) - s.find("/") if "/" in s else 0)
        held = np.array(sorted(lengths), dtype=np.uint64)
        head = np.array([MAGIC, n, len(held)], dtype=np.uint64)
        body = b"".join(x.tobytes() for x in (head, held, keys, ends, block)) + bytes(strings)
        path = scratch(spark, "url-index")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
        for i in range(0, len(body), 1 << 20):
            out.write(bytearray(body[i : i + (1 << 20)]))
        out.close()
        spark.sparkContext.addFile(path)
        return UrlIndex(path.rsplit("/", 1)[1])

    def open(self) -> UrlIndex:
        """Maps the file, on an executor."""
        data = np.memmap(SparkFiles.get(self.name), dtype=np.uint8, mode="r")
        magic, n, held = (int(x) for x in data[:24].view(np.uint64))
        if magic != MAGIC:
            raise ValueError("not a url index")
        at = 24 + 8 * held
        self.lengths = [int(x) for x in data[24:at].view(np.uint64)]
        self.keys, self.ends, self.block = data[at : at + 8 * n].view(np.uint64), data[at + 8 * n : at + 16 * n].view(np.uint64), data[at + 16 * n : at + 17 * n]
        self.strings = data[at + 17 * n :]
        return self

    def probe(self, asked: list[str]) -> np.ndarray:
        """The index of each string among the rules, or -1."""
        found = np.full(len(asked), -1, dtype=np.int64)
        if not len(self.keys) or not asked:
            return found
        keys = np.array([xxhash.xxh64_intdigest(x) for x in asked], dtype=np.uint64)
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys):
            j, want = int(at[i]), asked[i].encode()
            while j < len(self.keys) and self.keys[j] == keys[i]:  # more than one only where digests collide
                if self.strings[int(self.ends[j - 1]) if j else 0 : int(self.ends[j])].tobytes() == want:
                    found[i] = j
                    break
                j += 1
        return found


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """The possible rules of a url, the longest first, then the longer host."""
    labels = host.split(".") if host else []
    hosts = [h for i in range(len(labels)) if (h := ".".join(labels[i:]))]
    both = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return (x[2] for x in sorted(both, key=lambda x: (-x[0], -x[1])))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``urls`` with host, path, rule (null: none fits) and verdict."""
    index = UrlIndex.build(rules, max_bytes)
    if index is None:
        return judge_by_join(urls, rules, url, default)
    name = index.name

    @F.pandas_udf("rule string, block boolean")
    def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        opened = UrlIndex(name).open()
        for host, path in parts:
            asked, of = [], []
            for i, (h, p) in enumerate(zip(host, path, strict=True)):
                mine = list(candidates(h, p, opened.lengths))
                asked += mine
                of += [i] * len(mine)
            found = opened.probe(asked)
            rule, block = [None] * len(host), [None] * len(host)
            for i in np.flatnonzero(found >= 0)[::-1]:  # backwards: a url's longest comes last
                rule[of[i]], block[of[i]] = asked[i], bool(opened.block[found[i]])
            yield pd.DataFrame({"rule": pd.Series(rule, dtype=object), "block": pd.Series(block, dtype=object)})

    hit = free("_hit", urls)
    out = split_url(urls, url).withColumn(hit, look_up("host", "path"))
    verdict = F.when(F.col(f"{hit}.block"), "block").when(~F.col(f"{hit}.block"), "allow").otherwise(default)
    return out.withColumns({"rule": F.col(f"{hit}.rule"), "verdict": verdict}).drop(hit)


def judge_by_join(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The same for a list too large to ship: distinct (host, path) pairs, their candidates joined with the rules by string."""
    rules = clean_rules(rules)
    cut_at = F.instr("rule", "/")
    lengths = sorted(r[0] for r in rules.select(F.when(cut_at > 0, F.length("rule") - cut_at + 1).otherwise(0)).distinct().collect())  # at most the longest path
    out, hit = split_url(urls, url), free("_hit", urls)
    pairs = out.select("host", "path").distinct()
    hosts = F.expr("filter(transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, 1000000), '.')), h -> h != '')")
    asked = pairs.select("host", "path", F.explode(hosts).alias("_h")).select("host", "path", "_h", F.explode(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")).alias("_n"))
    asked = asked.where("_n <= length(path)").withColumn("rule", F.expr("concat(_h, substring(path, 1, _n))"))
    best = asked.join(rules, "rule").groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), F.length("_h"), "rule", "action")).alias(hit))
    joined = out.drop("rule", "verdict").join(best, ["host", "path"], "left")
    return joined.withColumns({"rule": F.col(f"{hit}.rule"), "verdict": F.coalesce(f"{hit}.action", F.lit(default))}).drop(hit)
