"""Spelling variants, byte-level BPE and centroid clustering against brute force, on odd rows and on no rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LOWER, empty, frame, odd
from tickspark.llm import byte_bpe, clustering, queries, spelling

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


# 11: spelling variants


def brute_words(rows):
    n = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    n = brute_words(rows)
    out = {}
    for w in n:
        near = sorted((x for x in n if one_apart(w, x)), key=lambda x: (-n[x], x))
        form = near[0] if near and n[near[0]] >= 5 * n[w] else None
        out[w] = [w, form, None, n[w], len(near), n[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][1]:
            root = out[root][1]
        r[2] = root
    return sorted(map(tuple, out.values()))


def misspelt(seed, letters="abé", base=6, size=3000):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randint(base, base + 3))) for _ in range(12)]
    words = []
    for _ in range(size):
        w = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            i = rng.randrange(len(w))
            w[i : i + 1] = rng.choice([[], [rng.choice(letters)], [w[i], rng.choice(letters)]])
        words.append("".join(w).upper() if rng.random() < 0.2 else "".join(w))
    return [(i, " ".join(words[i::50]), "a") for i in range(50)]


def variants(spark, rows):
    return sorted(map(tuple, spelling.variants(frame(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rows = misspelt(seed)
    assert variants(spark, rows) == brute_variants(rows)


def test_a_half_that_many_words_share_is_cut_to_blocks(spark):
    rng = random.Random(5)
    many = ["".join(rng.choices("abcd", k=3)) + "ending" for _ in range(400)] + ["common" + "".join(rng.choices("abcd", k=4)) for _ in range(400)]
    rows = [(i, " ".join(many), "a") for i in range(6)]
    vocabulary = spelling.words(frame(spark, rows)).cache()
    found = {r.word: (r.n_near, r.best) for r in spelling.near(vocabulary, shard=200).collect()}
    words = sorted(brute_words(rows))
    assert {w: sum(one_apart(w, x) for x in words) for w in words if any(one_apart(w, x) for x in words)} == {w: k for w, (k, _) in found.items()}
    assert found == {r.word: (r.n_near, r.best) for r in spelling.near(vocabulary).collect()}


def test_chains_of_forms_end_at_their_root(spark):
    steps = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]  # each five times as frequent as the one before
    rows = [(1, " ".join(w for i, w in enumerate(steps) for _ in range(5 * 6**i)), "a")]
    got = {w: (form, root) for w, form, root, *_ in variants(spark, rows)}
    assert got["aaaaaa"] == ("aaaaab", "aabbbb") and got["aabbbb"] == (None, "aabbbb")
    assert variants(spark, rows) == brute_variants(rows)


def test_words_of_odd_texts(spark):
    rows = [(r.doc_id, r.text, "") for r in odd(spark).collect()]
    rows += [(None, "Straße STRAßE straße strasse", "a")] * 6 + [(3, "q" * 100_000, "a"), (4, "q" * 99_999, "b")] * 5
    assert variants(spark, rows) == brute_variants(rows)
    assert spelling.variants(empty(spark)).isEmpty()


# 12: byte-level BPE


def tiktoken_code():
    import tiktoken

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def code():
    return byte_bpe.ByteBpe(VOCABULARY)


def strings(n, seed):
    rng = random.Random(seed)
    pools = ["abcdefgh ", "aaab", "-=_", " \n\t\r 　", "éüñß日本語한국", "\U0001f600\U0001f469‍\U0001f4bb", "0123456789", "'s't're've", "<|endoftext|>", "\x00\x1f\x85᠎﻿́"]
    for _ in range(n):
        yield "".join(rng.choice(rng.choice(pools)) * rng.choice([1, 1, 1, 2, 9]) for _ in range(rng.randint(0, 60)))


def test_ids_are_those_of_the_rank_file(code):
    want = tiktoken_code()
    for text in strings(3000, 1):
        ids = code.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(text)
        assert code.decode(ids) == text.encode()


def test_the_pattern_cuts_every_character_alike(code):
    want = tiktoken_code()
    for c in range(0x20000):
        if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 7 == 0):
            text = f"a{chr(c)}1 {chr(c)}a  {chr(c)}!{chr(c)} "
            assert np.frombuffer(code.encode(text), "<u4").tolist() == want.encode_ordinary(text), hex(c)


def test_windows_of_a_long_piece_give_the_tokens_of_the_whole(code):
    rng = random.Random(3)
    for pool in ("a", "ab", "etaoinshrdlu", "é日", "=-"):
        for size in (1, 63, 64, 65, 500, 3000):
            data = "".join(rng.choices(pool, k=size)).encode()
            whole = code.ids([code.mapped(data)])[0]
            for window in (16, 64):
                assert code.long_piece(data, window).tolist() == whole


def test_runs_of_any_length(code):
    for unit, tail in ((" ", "a"), ("a", ""), ("!", " b"), ("é", ""), ("\n", "x")):
        ids = code.encode(unit * 300_000 + tail)
        assert code.decode(ids) == (unit * 300_000 + tail).encode()
        short = np.frombuffer(code.encode(unit * 3_000 + tail), "<u4")
        assert Counter(np.frombuffer(ids, "<u4").tolist()).keys() == Counter(short.tolist()).keys()


def test_offsets_span_every_character_that_a_token_touches(code):
    for text in strings(300, 2):
        ids = np.frombuffer(code.encode(text), "<u4")
        starts, ends = code.offsets(text, ids.tobytes())
        at, of = 0, [i for i, c in enumerate(text) for _ in c.encode()]
        for i, a, b in zip(ids, starts, ends, strict=True):
            n = len(code.bytes_of[i])
            assert (a, b) == (of[at], of[at + n - 1] + 1)
            at += n


def test_encode_and_decode_of_frames(spark):
    rows = odd(spark).withColumns({"ids": F.lit(1), "decoded": F.lit("x"), "_both": F.lit(2)})
    got = byte_bpe.decode(byte_bpe.encode(rows, VOCABULARY, offsets=True), VOCABULARY)
    got = got.withColumns({"again": byte_bpe.packed(byte_bpe.unpacked("ids")), "back": byte_bpe.as_text("decoded")}).collect()
    want = tiktoken_code()
    assert len(got) == rows.count()
    for r in got:
        ids = want.encode_ordinary(r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.again == r.ids
        assert bytes(r.decoded) == (r.text or "").encode() and r.back == (r.text or "") and len(r.starts) == len(r.ends) == len(ids)
        assert r._both == 2 and r.score == "x"
    assert byte_bpe.decode(byte_bpe.encode(empty(spark), VOCABULARY), VOCABULARY).isEmpty()


def test_split_and_unknown_tokens(spark, code):
    emoji = np.frombuffer(code.encode("\U0001f9ff"), "<u4").tolist()
    assert len(emoji) > 1
    rows = spark.createDataFrame([(emoji,), (emoji[:1],), ([10**6, None, -1],), ([],), (None,)], "ids array<int>").withColumn("ids", byte_bpe.packed("ids"))
    got = [r[0] for r in byte_bpe.decode(rows, VOCABULARY).select(byte_bpe.as_text("decoded")).collect()]
    assert got == ["\U0001f9ff", "�", "�" * 3, "", None]


def test_the_query_equals_the_library(spark, sf):
    want = tiktoken_code()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op12_byte_bpe(spark, sf).collect():
        ids = want.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


# 13: centroid clustering


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string, v string")


def brute_clusters(rows, k, rounds, components):
    kept = [(i, [floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and x == x and abs(x) < inf for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            if mine := [v for (_, v), a in zip(kept, at, strict=True) if a == j]:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, j, d) for i, v in kept for d, j in [nearest(v)]), key=str), centroids


def odd_vectors(n, components, seed, spread):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-spread, spread) / 256 for _ in range(components)]) for i in range(n)]  # small integers: many ties
    rows += [(0, rows[0][1]), (None, rows[1][1]), (n, None), (n + 1, [1.0]), (n + 2, [None] * components), (n + 3, [nan] * components), (n + 4, [inf] * components), (n + 5, [-0.001] * components)]
    return rows


@pytest.mark.parametrize(("components", "spread", "k"), [(2, 2, 7), (3, 1, 12), (8, 300, 9), (2, 3, 1), (2, 2, 500)])
def test_clusters_equal_brute_force(spark, components, spread, k):
    rows = odd_vectors(150, components, k, spread)
    want, centroids = brute_clusters(rows, k, 3, components)
    assigned, found = clustering.cluster(vectors(spark, rows), k, 3, components)
    assert found.tolist() == centroids
    assert sorted(map(tuple, assigned.collect()), key=str) == want
    total = sum(d for _, _, d in want)
    for r in clustering.report(assigned, found).collect():
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_no_vectors(spark):
    none = vectors(spark, [(1, None), (2, [nan])])
    assigned, found = clustering.cluster(none, 5, 2)
    assert len(found) == 0 and clustering.report(assigned, found).isEmpty()


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(vectors(spark, [(1, [1e30])]), 2, 1, 1)


def test_the_tree_finds_ties_and_skips_centroids():
    rng = np.random.default_rng(1)
    centroids = np.concatenate([rng.integers(-3, 4, (40, 2)), rng.integers(-3000, 3000, (60, 2))])
    x = np.concatenate([rng.integers(-4, 5, (300, 2)), rng.integers(-3000, 3000, (300, 2))])
    number, best, taken = clustering.VpTree(centroids).search(x)
    d = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()
    assert taken < 0.5 * d.size
