"""Each operator on odd rows, on no rows, and against brute force or a round trip."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LOWER, empty, frame, odd, words
from tickspark.llm import byte_bpe, decontaminate, katz, line_dedup, media, mixing, ngram_join, quality, token_rollup, toxicity, url_filter
from tickspark.llm.common import scratch

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


# 1: URL filter


def urls(spark, values):
    return spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(values)], "page_id long, url string, host string, verdict string")


def rules(spark, *pairs):
    return spark.createDataFrame(list(pairs), "rule string, action string")


ODD_URLS = [None, "", "no scheme", "http://", "http:///path", "HTTP://A.Example.NET/x", "http://example.net/en/1", "http://m.example.net/en", "x://b.org/fr/?q", "http://borg/fr/", "http://net", "http://net/", "http://..net/", "a://b://c/", "http://x.example.net/en/" + "z" * 100_000]
RULES = [("net/", "block"), ("Example.net/en/", "allow"), ("org/fr/", "allow"), ("org/fr/", "block"), (None, "block"), ("b.org", "allow")]


def test_url_filter_on_odd_urls(spark):
    got = url_filter.judge(urls(spark, ODD_URLS), rules(spark, *RULES)).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in got] == [
        (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("org/fr/", "block"), (None, "allow"),
        (None, "allow"), ("net/", "block"), ("net/", "block"), (None, "allow"), ("example.net/en/", "allow"),
    ]
    assert url_filter.judge(urls(spark, []).limit(0), rules(spark, *RULES)).isEmpty()
    assert {r.verdict for r in url_filter.judge(urls(spark, ODD_URLS), rules(spark, *RULES).limit(0), default="allow").collect()} == {"allow"}


def test_a_list_too_large_to_ship_gives_the_same(spark):
    u, r = urls(spark, ODD_URLS), rules(spark, *RULES)
    shipped, joined = (sorted(map(tuple, url_filter.judge(u, r, max_bytes=m).select("page_id", "host", "path", "rule", "verdict").collect())) for m in (1 << 20, 0))
    assert shipped == joined


def test_colliding_digests_are_told_apart():
    index = url_filter.UrlIndex("x")
    key = url_filter.xxhash.xxh64_intdigest("b/")
    index.keys, index.block = np.array([key, key], np.uint64), np.array([1, 0], np.uint8)
    index.strings, index.ends = np.frombuffer(b"a/b/", np.uint8), np.array([2, 4], np.uint64)
    assert index.probe(["b/", "a/", "c/"]).tolist() == [1, -1, -1]


# 2: media columns


def test_media_round_trip(spark):
    docs = odd(spark)
    folder = scratch(spark, "media")
    got = media.media_columns(docs, folder).collect()
    assert len(got) == docs.count()
    by_sha = {}
    for r in docs.collect():
        raw = (r.text or "").encode()
        data = raw + b" " * (-len(raw) % 192 if raw else 192)
        by_sha[hashlib.sha256(data).hexdigest()] = (len(raw), len(data), zlib.crc32(data[-16:]))
    for r in got:
        assert (r.payload_bytes, r.tail_crc32) == by_sha[r.payload_sha256][1:] and r.digest == r.payload_sha256
        assert r.width == 192 and r.height * 192 == r.payload_bytes
    system, root = media.file_system(folder)
    r = got[0]
    with system.open_input_file(f"{root}/{r.shard}") as f:
        f.seek(r.offset)
        image = f.read(r.length)
    assert hashlib.sha256(image).hexdigest() == r.media_sha256 and hashlib.sha256(media.decode(image)).hexdigest() == r.payload_sha256
    assert media.media_columns(empty(spark)).isEmpty()


def test_features_and_sizes_are_those_of_the_stored_images(spark):
    texts = ["", "short", "x" * 192, "abc " * 1000, "é" * 500]
    for r in media.media_columns(frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect():
        data = media.payload(texts[r.doc_id].encode())
        x = list(data)
        mean = sum(x) / len(x)
        spread = math.sqrt(sum((v - mean) ** 2 for v in x) / len(x))
        steps = sum(a != b for a, b in zip(x, x[1:], strict=False)) / (len(x) - 1)
        height, cells = len(x) // 192, []
        for k in range(8):
            a, b = min(k * height // 8, height - 1), (k + 1) * height // 8
            for c in range(0, 192, 24):
                block = [x[y * 192 + z] for y in range(a, max(b, a + 1)) for z in range(c, c + 24)]
                cells.append(sum(block) / len(block))
        bits = "".join(str(int(v > sum(cells) / 64)) for v in cells)
        assert r.feature == f"{mean:.4f}:{spread:.4f}:{steps:.4f}:{int(bits, 2):016x}"
        image = media.encode(data)
        assert (r.length, r.media_sha256, r.n_bytes) == (len(image), hashlib.sha256(image).hexdigest(), len(texts[r.doc_id].encode()))


def test_shards_are_tar_files_with_every_payload_once_a_task(spark):
    import tarfile

    folder = scratch(spark, "tar")
    docs = frame(spark, [(i, f"text {i % 3}", "a") for i in range(30)]).coalesce(1)
    index = media.store(docs, folder, shard_bytes=1)
    system, root = media.file_system(folder)
    names = [m.name for s in sorted(r.shard for r in index.select("shard").distinct().collect()) for m in tarfile.open(f"{root}/{s}")]
    assert len(names) == 3 == index.count()


def test_headers_alone_fill_the_metadata(spark):
    folder = scratch(spark, "heads")
    rows = media.read(media.store(odd(spark), folder), folder, samples=False)
    assert "feature" not in rows.columns and rows.agg(F.min("bit_depth")).first()[0] == 8


# 3: Katz backoff


def brute_katz(docs):
    texts = {i: [*words(t), "\n"] for i, t in docs}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    c, b = Counter(), Counter()
    for i in train:
        c.update(texts[i])
        b.update(zip(["<s>", *texts[i]], texts[i], strict=False))
    n = sum(c.values())
    d1, d2 = katz.discounts(Counter(c.values())), katz.discounts(Counter(b.values()))

    def cut(x, d):
        return x * (d[x] if x <= 5 else 1)

    whole = n if sum(cut(x, d1) for x in c.values()) < n - 1e-9 else n + 0.5
    p = {w: cut(x, d1) / whole for w, x in c.items()}
    unknown = 1 - sum(p.values())
    sums = {}
    for (h, w), x in b.items():
        s = sums.setdefault(h, [0, 0, 0])
        s[0] += x
        s[1] += cut(x, d2)
        s[2] += p[w]

    def prob(h, w):
        if h not in sums:
            return p.get(w, unknown)
        total, kept, seen = sums[h]
        whole = total if kept < total - 1e-9 else total + 0.5
        return cut(b[h, w], d2) / whole if b[h, w] else (1 - kept / whole) / (1 - seen) * p.get(w, unknown)

    for h in list(sums)[:20]:  # exactly normalised
        assert sum(prob(h, w) for w in c) + prob(h, "never seen") == pytest.approx(1, abs=1e-9)
    out = {}
    for i, t in texts.items():
        score, h = 0.0, "<s>"
        for w in t:
            score += math.log10(prob(h, w))
            h = w if w in c else "<unknown>"
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in t)
        out[i] = (len(t), sum(c[w] > 0 for w in t), n, base, score)
    return out


def corpus(n, seed=3, vocabulary=60):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices([f"w{k}" for k in range(vocabulary)], [1 / (k + 1) for k in range(vocabulary)], k=rng.randint(0, 60))), "a") for i in range(n)]


def test_katz_equals_brute_force(spark):
    rows = corpus(120)
    want = brute_katz([(i, t) for i, t, _ in rows])
    for r in katz.score(frame(spark, rows)).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][3:], abs=1e-8)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)


def test_katz_with_a_small_vocabulary_keeps_the_exact_base(spark):
    rows = corpus(120)
    want = brute_katz([(i, t) for i, t, _ in rows])
    for r in katz.score(frame(spark, rows), vocabulary=10).collect():
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and r.base_score == pytest.approx(want[r.doc_id][3], abs=1e-8) and r.score <= 0


@pytest.mark.parametrize("cached", [0, 1, 10])
def test_katz_models_words_outside_the_cache(spark, cached):
    rows = corpus(120)
    rows += [(120 + i, f"w0 rare{i} w1 rare{i // 2} w2", "a") for i in range(40)]
    want = brute_katz([(i, t) for i, t, _ in rows])
    for r in katz.score(frame(spark, rows), vocabulary=cached).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][3:], abs=1e-8)


def brute_orders(docs, order):
    """Katz by its recursive definition over tuples of words; checks that each history's probabilities add up to 1."""
    texts = {i: [*words(t), "\n"] for i, t in docs}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    grams = {m: Counter() for m in range(1, order + 1)}
    for i in train:
        padded = ["<s>"] * (order - 1) + texts[i]
        for k in range(order - 1, len(padded)):
            for m in grams:
                grams[m][tuple(padded[k - m + 1 : k + 1])] += 1
    d = {m: katz.discounts(Counter(c.values())) for m, c in grams.items()}

    def kept(m, n):
        return n * (d[m][n] if n <= 5 else 1)

    total = sum(grams[1].values())
    single = sum(kept(1, n) for n in grams[1].values())
    whole = {1: {(): total if single < total - 1e-9 else total + 0.5}}
    after = {m: {} for m in grams}
    for m in range(2, order + 1):
        for g in grams[m]:
            after[m].setdefault(g[:-1], []).append(g[-1])
        whole[m] = {}
        for h, ws in after[m].items():
            n, k = sum(grams[m][(*h, w)] for w in ws), sum(kept(m, grams[m][(*h, w)]) for w in ws)
            whole[m][h] = n if k < n - 1e-9 else n + 0.5

    def prob(h, w):
        m = len(h) + 1
        if grams[m][(*h, w)]:
            return kept(m, grams[m][(*h, w)]) / whole[m][h]
        if m == 1:
            return 1 - single / whole[1][()]
        if h not in after[m]:
            return prob(h[1:], w)
        rest = 1 - sum(prob(h, x) for x in after[m][h])
        return rest / (1 - sum(prob(h[1:], x) for x in after[m][h])) * prob(h[1:], w)

    for m in range(2, order + 1):
        for h in list(after[m])[:8]:
            assert sum(prob(h, w) for (w,) in grams[1]) + prob(h, "never seen") == pytest.approx(1, abs=1e-9)
    out = {}
    for i, t in texts.items():
        padded = ["<s>"] * (order - 1) + t
        out[i] = sum(math.log10(prob(tuple(padded[k - order + 1 : k]), padded[k])) for k in range(order - 1, len(padded)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz_of_any_order_equals_brute_force(spark, order):
    from tickspark.llm import katz_orders

    rows = corpus(80, seed=order, vocabulary=25)
    rows += [(80 + i, f"w0 rare{i} w1 rare{i // 2} w2", "a") for i in range(20)] + [(200, rows[3][1], "a")]
    want, base = brute_orders([(i, t) for i, t, _ in rows], order), brute_katz([(i, t) for i, t, _ in rows])
    for r in katz_orders.score(frame(spark, rows), order).collect():
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-8)
        assert (r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:3] and r.base_score == pytest.approx(base[r.doc_id][3], abs=1e-8)


def test_katz_orders_on_odd_rows(spark):
    got = katz.score(odd(spark), order=3).collect()
    assert len(got) == 12 and all(math.isfinite(r.score) and r.score <= 0 for r in got) and katz.score(empty(spark), order=3).isEmpty()


def test_katz_on_odd_rows(spark):
    got = katz.score(odd(spark)).collect()
    assert len(got) == 12 and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert len({r.score for r in got if r.n_tokens == 1}) == 1
    assert katz.score(empty(spark)).isEmpty()
    alone = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][0]
    r = katz.score(frame(spark, [(alone, "only held out", "a")])).first()
    assert r.train_tokens == 0 and r.n_known == 0 and r.score == 0


# 4: n-gram Jaccard join


def brute_groups(rows, n, num, den):
    sets = {}
    for i, t, _ in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if k * den >= num * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("n", "similarity"), [(4, (85, 100)), (5, (80, 100)), (2, (50, 100))])
def test_near_duplicates_equal_brute_force(spark, n, similarity):
    rng = random.Random(5)
    bases = [[f"w{rng.randint(0, 500)}" for _ in range(rng.randint(1, 150))] for _ in range(25)]
    rows = []
    for i in range(300):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(w) if i % 50 else ["", None][i // 50 % 2], "a"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(frame(spark, rows), n, similarity).collect()}
    assert got == brute_groups(rows, n, *similarity)


def test_groups_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]]), "a") for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(frame(spark, rows), 4, (85, 100)).collect()}
    assert got == brute_groups(rows, 4, 85, 100)


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(1)
    for size in (7, 12, 30, 80, 200, 600):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            most = int(len(a) * 0.15 / 1.85)
            drop = rng.choice(len(a), rng.integers(0, most + 1), replace=False)
            b = np.unique(np.concatenate([np.delete(a, drop), rng.integers(0, 2**63, rng.integers(0, most + 1), dtype=np.uint64)]))
            k = len(np.intersect1d(a, b))
            if k * 100 >= 85 * (len(a) + len(b) - k) and len(a) != k:
                assert len(np.intersect1d(ngram_join.signatures(a, 85, 100), ngram_join.signatures(b, 85, 100)))


def test_near_duplicates_on_odd_rows(spark):
    got = ngram_join.near_duplicates(odd(spark))
    assert got.count() == 12 and ngram_join.near_duplicates(empty(spark)).isEmpty()
    assert {r.component_id for r in got.where("doc_id in (7, 8)").collect()} == {7}
    kept = ngram_join.keep_one(odd(spark))
    assert kept.where("doc_id = 5").count() == 1 and kept.where("doc_id = 8").isEmpty() and kept.where("doc_id is null").count() == 2
    assert kept.columns == odd(spark).columns


def test_rows_that_share_an_id_but_not_a_text_are_not_lost(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = frame(spark, [(1, a, "s"), (2, a, "s"), (2, b, "s"), (3, f"{a} more", "s"), (3, f"{a} other", "s"), (4, b + " x", "s"), (5, None, "s"), (5, "", "s"), (None, a, "s"), (None, "alone here", "s"), (6, "twice", "s"), (6, "twice", "s")])
    kept = sorted(((r.doc_id or 0, r.text) for r in ngram_join.keep_one(docs).collect()), key=str)
    assert kept == sorted([(0, "alone here"), (1, a), (2, b), (5, None), (5, ""), (6, "twice")], key=str)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.near_duplicates(docs.where("text is not null")).collect()}
    assert got[2, 36] == 2 and got[3, 37] == 1 and got[1, 36] == 1


@pytest.mark.parametrize(("num", "den"), [(85, 100), (80, 100), (1, 2)])
def test_signatures_stay_in_proportion_to_the_difference(num, den):
    for band in range(1, 28):
        parts, spare = ngram_join.parts_of(band, num, den)
        k = 2 * ngram_join.bands(num, den)[band][1] * (den - num) // (den + num)
        assert not k and not parts or (parts - spare) * 2 > k >= (parts - spare - 1) * 2


# 5: line dedup


def test_line_dedup_on_runs(spark):
    run = [" ".join(f"r{i}x{k}" for k in range(20)) for i in range(4)]
    rows = [
        (1, "\n".join(["first line", *run, "end one"]), "a"),
        (2, "\n".join(["Other", *[r.upper() for r in run], "", "end two"]), "a"),  # the run in capitals
        (3, "\n".join([*run[:2], "broken"]), "a"),  # 40 words only
        (4, "\n".join(["x", *run[1:], "x"]), "a"),  # 60 of the words
        (5, "\n".join(run + ["between"] + run), "a"),  # twice in one text
    ]
    got = {r.doc_id: r for r in line_dedup.dedup(frame(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[3].text == rows[2][1]
    assert got[2].text == "Other\n\nend two" and got[4].text == "x\nx" and got[5].text == "between"
    assert (got[2].n_lines, got[2].n_deleted) == (7, 4)


def brute_runs(rows, min_words):
    """The lines with words that stay when maximal runs of equal lines that an earlier document has, found along each diagonal, go; lines differ within a text."""
    import re

    texts = {i: [(k, line.strip(" ").lower(), len(words(line))) for k, line in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", line)] for i, t, _ in rows}
    out = {}
    for i, t, _ in rows:
        gone = set()
        for j in (j for j in texts if j < i):
            a, b = texts[i], texts[j]
            for by in range(-len(b) + 1, len(a)):
                run = []
                for p in [*range(max(0, by), min(len(a), len(b) + by)), None]:
                    if p is not None and a[p][1] == b[p - by][1]:
                        run.append(p)
                        continue
                    if run and sum(a[q][2] for q in run) >= min_words:
                        gone |= {a[q][0] for q in run}
                    run = []
        out[i] = (t.count("\n") + 1, [x for k, x in enumerate(t.split("\n")) if k not in gone and words(x)])
    return out


@pytest.mark.parametrize("min_words", [1, 12, 50])
def test_line_dedup_equals_maximal_runs(spark, min_words):
    rng = random.Random(min_words)
    pool = [" ".join(f"l{i}x{k}" for k in range(rng.choice([1, 1, 2, 3, 8, 20, 60]))) for i in range(120)]
    rows = []
    for i in range(60):
        lines, at = [], rng.randrange(100)
        for _ in range(rng.randint(0, 6)):  # stretches of the pool, in new company
            at = (at + rng.randint(1, 20)) % 120
            lines += [x for x in pool[at : at + rng.randint(1, 12)] if x not in lines]
            lines += rng.choice([[], [""], [f"own {i} {len(lines)}"], [" \t"]])
        rows.append((i, "\n".join(rng.choice([x, x.upper(), f" {x}  "]) for x in lines), "a"))
    got = {r.doc_id: (r.n_lines, [x for x in r.text.split("\n") if words(x)]) for r in line_dedup.dedup(frame(spark, rows), min_words).collect()}
    assert got == brute_runs(rows, min_words)


def test_fingerprints_are_fewer_than_lines(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(10)) for _ in range(200)), "a") for i in range(20)]
    prints = line_dedup.fingerprints(line_dedup.line_arrays(frame(spark, rows)), 50)
    assert prints.count() < 0.55 * 20 * 200


def test_a_very_common_passage_and_line(spark):
    run = "\n".join(" ".join(f"r{i}x{k}" for k in range(20)) for i in range(4))
    rows = [(i, f"start {i}\n{run}\nend {i}" if i % 2 else f"{run.split(chr(10))[i % 4]}\n" + " ".join(f"q{i}x{k}" for k in range(60)), "a") for i in range(400)]
    got = {r.doc_id: r.n_deleted for r in line_dedup.dedup(frame(spark, rows)).collect()}
    assert got == {i: 4 * (i % 2 and i > 1) for i in range(400)}


def test_kept_columns_may_have_any_name(spark):
    run = " ".join(f"r{k}" for k in range(60))
    docs = frame(spark, [(1, run, "a"), (2, f"x\n{run}", "a")])
    for c in ("_text", "_runs", "runs", "row", "cut", "kept", "n", "id", "of", "_l", "f", "windows"):
        docs = docs.withColumn(c, F.lit("mine"))
    got = line_dedup.dedup(docs)
    assert {(r.text, r["_text"], r.kept, r.runs, r.row) for r in got.collect()} == {(run, "mine", "mine", "mine", "mine"), ("x", "mine", "mine", "mine", "mine")}


def test_line_dedup_keeps_the_first_of_two_in_one_text(spark):
    run = "\n".join(" ".join(f"r{i}x{k}" for k in range(20)) for i in range(4))
    assert line_dedup.dedup(frame(spark, [(1, f"{run}\nmiddle\n{run}", "a")])).first().text == f"{run}\nmiddle"


def test_line_dedup_on_odd_rows(spark):
    got = line_dedup.dedup(odd(spark))
    assert got.count() == 12 and got.where("doc_id = 1").first().text is None and line_dedup.dedup(empty(spark)).isEmpty()
    assert got.where("doc_id = 5").agg(F.sum("n_deleted")).first()[0] == 0
    copies = frame(spark, [(i, " ".join(f"w{k}" for k in range(60)), "a") for i in (3, 1, None, 2)])
    assert {r.doc_id: r.text == "" for r in line_dedup.dedup(copies).collect()} == {1: False, 2: True, 3: True, None: True}


# 6: token counts


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long, seq int")


def totals(rollup):
    return {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_rollup_by_deltas_equals_a_recount_and_commits_once(spark):
    t = token_rollup.TokenRollup(spark, scratch(spark, "rollup"))
    assert totals(t) == {}
    first = changes(spark, ("insert", 1, "a", "en", "t", 5, 0), ("insert", 2, "a", "en", "t", 7, 0), ("insert", None, None, None, "t", None, 0), ("insert", 3, "b", "en", "t", 1, 0), ("insert", 3, "b", "de", "t", 2, 1))
    assert t.commit(1, first) and totals(t) == {("a", "en"): (2, 12), (None, None): (1, 0), ("b", "de"): (1, 2)}
    assert not t.commit(1, first)
    second = changes(spark, ("delete", 1, None, None, "t", None, 0), ("revise", 2, "b", "de", "t", 10, 0), ("delete", 9, "a", "en", "t", 3, 0), ("odd", 2, "z", "z", "t", 1, 9))
    assert t.commit(2, second) and totals(t) == {(None, None): (1, 0), ("b", "de"): (2, 12)}
    assert not t.commit(2, second) and totals(t) == {(None, None): (1, 0), ("b", "de"): (2, 12)}
    assert t.commit(3, changes(spark, ("insert", 1, "a", "en", "t", 4, 0))) and totals(t)["a", "en"] == (1, 4)
    with pytest.raises(ValueError):
        token_rollup.TokenRollup(spark, t.folder).commit(0, first)


def test_a_broken_off_batch_is_overwritten(spark):
    t = token_rollup.TokenRollup(spark, scratch(spark, "rollup"))
    spark.createDataFrame([("a", "en", "t", 99, 99)], "source string, lang string, tokenizer string, docs long, tokens long").write.parquet(f"{t.folder}/deltas/batch=1")
    assert totals(t) == {}
    t.commit(1, changes(spark, ("insert", 1, "a", "en", "t", 5, 0)))
    assert totals(t) == {("a", "en"): (1, 5)}


def test_rows_that_share_an_id_or_have_none_all_count(spark, tmp_path):
    from tickspark.llm import queries

    rows = [(None, "no id"), (None, "none here either"), (1, "a b"), (1, "c d e"), (1, "a b"), (2, "junk"), (2, "more junk"), (3, "toxic one"), (3, "toxic two too")]
    frame(spark, [(i, t, "s") for i, t in rows]).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {(r.source, r.tokenizer): (r.docs, r.tokens) for r in queries.op6_token_counts(spark, str(tmp_path)).collect()}
    assert got["s", "words-1"] == (5, 12) and got["quarantine", "words-1"] == (2, 5)
    assert got["s", "byte-bpe-50k-1"][0] == 5 and got["quarantine", "byte-bpe-50k-1"][0] == 2


def test_token_counts_of_odd_rows(spark):
    got = token_rollup.count_tokens(odd(spark), VOCABULARY, "v").collect()
    assert len(got) == 24
    import tiktoken

    assert {r.n_tokens for r in got if r.doc_id == 4 and r.tokenizer == "v"} == {1} and tiktoken
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert token_rollup.count_tokens(empty(spark), VOCABULARY, "v").isEmpty()


def test_the_three_batches_equal_a_recount_of_the_whole_tables(spark, sf):
    """Words and pieces of every document counted apart from the rollup, with what the labels say done to the sums."""
    import base64

    import tiktoken

    from tickspark.llm import queries

    with open(VOCABULARY, "rb") as f:
        code = tiktoken.Encoding("recount", pat_str=byte_bpe.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    marks = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        q, t = marks.get(r.doc_id, (1, 0))
        marks[r.doc_id] = (min(q, r.quality), max(t, r.toxic))
    want = Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        q, t = marks.get(r.doc_id, (1, 0))
        if q == 0 and r.doc_id in marks:
            continue
        source = "quarantine" if t == 1 else r.source
        for tokenizer, n in (("words-1", len(words(r.text))), ("byte-bpe-50k-1", len(code.encode_ordinary(r.text or "")))):
            want[source, r.lang, tokenizer, "docs"] += 1
            want[source, r.lang, tokenizer, "tokens"] += n
    got = {(r.source, r.lang, r.tokenizer, k): r[k] for r in queries.op6_token_counts(spark, sf).collect() for k in ("docs", "tokens")}
    assert got == dict(want)


def test_a_small_batch_reads_only_the_buckets_it_touches(spark):
    t = token_rollup.TokenRollup(spark, scratch(spark, "rollup"))
    t.commit(1, changes(spark, *[("insert", i, "a", "en", "t", 1, 0) for i in range(500)]))
    one = t.state([3])
    assert 0 < one.count() < 50 and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    t.commit(2, changes(spark, ("delete", 7, None, None, "t", None, 0)))
    assert totals(t) == {("a", "en"): (499, 499)}


# 7: quality


def test_quality_agrees_with_labels_it_never_saw(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = quality.score(docs, *quality.fit(docs)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = scored.agg(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("keep").cast("int")))).first()
    assert r[0] > 0.9 and r[1] > 0.95


def test_batches_vote_and_score_as_single_texts_do(spark, sf):
    import pandas as pd

    texts = [None, b"", b"  \n ", b"one", b"A a A a b! 9 9 9 ... ..", "é ü ñ 日本 ‰ é, é. aaBB12 aaBB12".encode(), b"x " * 5000, b"\x0bodd\x0cwhite\rspace " * 9, *[(r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]]
    weights = np.random.default_rng(3).normal(size=quality.WIDTH + 1)
    batch = quality.Batch(pd.Series(texts, dtype=object))
    assert batch.votes() == ["".join(".jg"[v + 1] for v in quality.votes_of(t)) for t in texts]
    one = [(i, x) for i, x in map(quality.features, texts)]
    assert batch.dot(weights) == pytest.approx([float(weights[i] @ x) + weights[-1] for i, x in one], abs=1e-9)
    assert quality.Batch(pd.Series([], dtype=object)).votes() == [] and len(quality.Batch(pd.Series([], dtype=object)).dot(weights)) == 0
    assert quality.Batch(pd.Series([None, b""], dtype=object)).dot(weights) == pytest.approx([weights[-1]] * 2)


def plain_em(rows, rounds=100):
    """EM over single documents, without counting patterns."""
    q = [0.5 / (r.count("j") + 0.5) if "j" in r else 0.95 if "g" in r else 0.5 for r in rows]
    for _ in range(rounds):
        prior = (sum(q) + 1) / (len(q) + 2)
        says = {}
        for y in (0, 1):
            for k in range(len(rows[0])):
                c = {"j": 1 + 2 * (y == 0), "g": 1 + 2 * (y == 1)}
                for r, p in zip(rows, q, strict=True):
                    if r[k] != ".":
                        c[r[k]] += p if y else 1 - p
                says[y, k] = {v: math.log(n / sum(c.values())) for v, n in c.items()} | {".": 0.0}
        new = []
        for r in rows:
            a, b = (math.log(p) + sum(says[y, k][v] for k, v in enumerate(r)) for y, p in ((0, 1 - prior), (1, prior)))
            new.append(1 / (1 + math.exp(max(-50, min(50, a - b)))))
        if max(abs(x - y) for x, y in zip(new, q, strict=True)) < 1e-9:
            break
        q = new
    return dict(zip(rows, q, strict=True))


def test_em_on_patterns_equals_em_on_documents():
    rng = random.Random(4)
    rows = ["".join(rng.choices("jg.", [0.3, 0.5, 0.2])[0] for _ in range(4)) for _ in range(300)]
    want = plain_em(rows)
    assert quality.LabelModel(Counter(rows)).posterior == {k: pytest.approx(v, abs=1e-7) for k, v in want.items()}


def test_the_fit_equals_a_plain_one(spark):
    """The scorer of the fit, from posteriors, one text and one weight at a time."""
    rng = random.Random(12)
    good, junk = ["river", "stone", "Meadow", "quietly", "evening,", "walked.", "under", "lights"], ["$$", "##", "!!!", "x"]
    rows = [(i, " ".join(rng.choices(good if i % 3 else junk, k=rng.randint(8, 30))), "a") for i in range(90)]
    model, weights = quality.fit(frame(spark, rows + rows[:40]), examples=60)  # repeated rows are one example
    by_hash = [r.id for r in spark.range(90).orderBy(F.xxhash64("id"), "id").limit(60).collect()]
    said = ["".join(".jg"[v + 1] for v in quality.votes_of(t.encode())) for _, t, _ in rows]
    assert model.posterior == {k: pytest.approx(v, abs=1e-7) for k, v in plain_em(said + said[:40]).items()}
    order = [sorted(by_hash)[k] for k in np.random.default_rng(7).permutation(60)]
    w, g = Counter(), Counter()
    for _ in range(8):
        for i in order:
            at, x = quality.features(rows[i][1].encode())
            x = x.astype(np.float32).astype(float)
            z = sum(w[int(k)] * v for k, v in zip(at, x, strict=True)) + w["bias"]
            off = model.posterior[said[i]] - 1 / (1 + math.exp(-z))
            for k, v in [*zip(at.tolist(), x.tolist(), strict=True), ("bias", 1.0)]:
                g[k] += (off * v) ** 2
                w[k] += 0.5 * off * v / math.sqrt(1e-6 + g[k])
    got = {k: weights[quality.WIDTH if k == "bias" else k] for k in w}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in w.items()} and np.count_nonzero(weights) == len(w)


def test_an_id_that_repeats_is_one_example(spark):
    rows = [(1, f"some text number {i % 7} with a few more words in it", "a") for i in range(10_000)] + [(2, "another text with words enough to get a vote", "a")]
    docs = frame(spark, rows)
    assert quality.fit(docs, examples=2)[1].any()
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.examples_of(docs, labels, 2).groupBy("doc_id").count().where("count > 1").isEmpty()


def test_em_finds_who_is_right():
    rng, patterns = random.Random(2), Counter()
    for _ in range(4000):
        good = rng.random() < 0.8
        patterns["".join(rng.choices("jg." if good else "gj.", [1 - a - 0.1, a, 0.1])[0] for a in (0.85, 0.8, 0.55))] += 1
    m = quality.LabelModel(patterns)
    assert 0.7 < m.prior < 0.9 and m.rates[1, 0, 1] > m.rates[1, 2, 1] and m.posterior["ggg"] > 0.9 > 0.5 > m.posterior["jjj"]


def test_quality_on_odd_rows(spark):
    got = quality.score(odd(spark), *quality.fit(odd(spark)))
    assert got.count() == 12 and got.where("score is null or keep is null").isEmpty()
    assert quality.score(empty(spark), *quality.fit(empty(spark))).isEmpty()


# 8: mixing


def test_mix_reaches_targets_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", None])) for i in range(400)]
    a, b = (sorted(map(tuple, mixing.mix(frame(spark, rows)).select("doc_id", "source", "size", "target", "taken").collect()), key=str) for _ in range(2))
    assert a == b
    by = {}
    for _, source, size, target, taken in a:
        assert 0 <= taken <= 2 * size
        s = by.setdefault(source, [0, 0, target])
        s[0] += size
        s[1] += taken
    assert all(abs(taken - target) <= 1 and target <= 2 * size for size, taken, target in by.values())
    assert sum(t for *_, t in by.values()) == pytest.approx(1.5 * sum(s for s, *_ in by.values()))


def reshared(sizes, weights=(5, 2, 1)):
    """Targets by resharing in rounds, as the definition says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing_in_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, 100, 10_000]) + rng.randint(0, 9) for s in [None, *"abcdefgh"]}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = reshared(sizes)
    assert got == {s: pytest.approx(want[s]) for s in sizes}


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 10, "a" if i < 1000 else "b") for i in range(3000)]
    docs = frame(spark, rows)
    weight = spark.createDataFrame([(i, 4.0 if i % 2 else 1.0) for i in range(3000)], "doc_id long, weight double")
    got = mixing.mix(docs, weight).where("source = 'b'").groupBy(F.col("doc_id") % 2).agg(F.avg("taken")).collect()
    share = {r[0]: r[1] for r in got}
    assert share[1] > share[0]


def test_mix_on_odd_rows(spark):
    got = mixing.mix(odd(spark))
    assert got.count() == 12 and got.where("taken is null or taken > 2 * size").isEmpty() and mixing.mix(empty(spark)).isEmpty()


# 9: decontamination


def item_words(text):
    return decontaminate.words_of((text or "").encode())


def brute_hits(docs, items, window=10):
    windows = [(str(i), tuple(w[k : k + window])) for i, t in items for w in [item_words(t)] if w for k in range(max(1, len(w) - window + 1))]
    out = {}
    for i, t, _ in docs:
        w, hit, found = item_words(t), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(item)
        out[i] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randint(0, 6)}" for _ in range(rng.choice([3, 8, 10, 12, 30])))) for k in range(12)] + [(98, None), (99, "...")]
    docs = []
    for i in range(60):
        w = [f"W{rng.randint(0, 6)}" for _ in range(rng.randint(0, 60))]
        if i % 3:
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(items[:12])[1].split()
        docs.append((i, ", ".join(w), "a"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.decontaminate(frame(spark, docs), bench, block_bytes=block_bytes).collect()}
    assert got == brute_hits(docs, items)


def test_decontamination_on_odd_rows(spark):
    bench = spark.createDataFrame([(1, "one"), (None, "same text here")], "item_id long, text string")
    got = decontaminate.decontaminate(odd(spark), bench)
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in got.where("contaminated").collect()} == {(4, 1, ("1",)), (5, 3, ("null",))}
    assert got.count() == 12 and decontaminate.decontaminate(odd(spark), bench.limit(0)).where("contaminated").isEmpty() and decontaminate.decontaminate(empty(spark), bench).isEmpty()


# 10: toxicity


def test_the_index_finds_the_nearest_exactly():
    import pandas as pd

    rng = random.Random(8)
    terms = [f"t{i}" for i in range(30)]
    ex = pd.DataFrame({"doc_id": range(200), "toxic": [i % 2 for i in range(200)], "h": range(200), "group_id": range(200), "terms": [rng.sample(terms, rng.randint(0, 6)) for _ in range(200)]})
    ex["counts"] = [[rng.randint(1, 5) for _ in t] for t in ex["terms"]]
    m = toxicity.Neighbours(terms, np.array([1 + i / 10 for i in range(30)]), ex, 7)
    dense = {int(i): np.zeros(30) for i in range(200)}
    for i, (t, c) in enumerate(zip(ex["terms"], ex["counts"], strict=True)):
        at, x = m.vector(Counter(dict(zip(t, c, strict=True))))
        dense[i][at] = x
    for _ in range(50):
        q = Counter({t: rng.randint(1, 4) for t in rng.sample(terms, rng.randint(1, 5))})
        at, x = m.vector(q)
        v = np.zeros(30)
        v[at] = x
        ids, cosines = m.nearest(at, x)
        want = sorted((round(float(d @ v), 9) for d in dense.values() if d @ v > 0), reverse=True)[:7]
        assert [round(float(c), 9) for c in cosines] == want
        assert [round(float(dense[int(m.ids[i])] @ v), 9) for i in ids] == want


def test_held_out_toxic_documents_are_found(spark):
    rng = random.Random(6)
    bad = ["scumword", "vileword", "rotword"]
    rows, marks = [], []
    for i in range(600):
        w = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad).upper()
        rows.append((i, " ".join(w), "a"))
        marks.append((i, 1, int(toxic)))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    wrong = [r.doc_id for r in got if r.held_out and r.predicted != int(r.doc_id % 5 == 0)]
    assert not wrong and all(0 <= r.score <= 1 for r in got) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(len(r.neighbours) and max(r.cosines) > 0 for r in got if r.predicted)


def isotonic(pairs):
    """The monotone fit by its min-max formula: at the i-th point, the largest over starts of the least mean up to any end."""
    pairs = sorted(pairs)
    y = [b for _, b in pairs]
    return [max(min(sum(y[a : b + 1]) / (b + 1 - a) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))], [a for a, _ in pairs]


def test_scores_equal_brute_force(spark):
    """Terms by their definition, dense vectors, all cosines, votes and the monotone fit, one after the other."""
    rng = random.Random(3)
    bad = ["scumword", "vileword", "rotword", "foulword"]
    texts, toxic = {}, {}
    for i in range(400):
        w = [f"w{rng.randint(0, 60)}x" for _ in range(rng.randint(4, 12))]
        toxic[i] = int(rng.random() < 0.3)
        for _ in range(rng.randint(1, 2) if toxic[i] or rng.random() < 0.04 else 0):
            w[rng.randrange(len(w))] = rng.choice(bad)
        texts[i] = " ".join(w)
    docs = frame(spark, [(i, t, "a") for i, t in texts.items()])
    model = toxicity.fit(docs, spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int"), k=5)

    train = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    terms = {i: Counter(t for w in words(texts[i]) for t in [w, *(w[:n] + "*" for n in range(4, min(len(w), 7) + 1))]) for i in texts}
    groups = {i: toxicity.group_of(toxicity.words(texts[i])) for i in train}
    by_group = {}
    for i in train:
        by_group[groups[i]] = max(by_group.get(groups[i], 0), toxic[i])
    rate = sum(by_group.values()) / len(by_group)
    chosen = []
    for t in {t for i in train for t in terms[i]}:
        seen = {}
        for i in train:
            if t in terms[i]:
                seen.setdefault(groups[i], []).append(toxic[i])
        a, c = sum(max(x) for x in seen.values()), sum(1 - min(x) for x in seen.values())
        tail = sum(math.comb(a + c, k) * rate**k * (1 - rate) ** (a + c - k) for k in range(a, a + c + 1))
        if a >= toxicity.MIN_GROUPS and a >= toxicity.PURITY * (a + c) and tail < toxicity.P_VALUE:
            chosen.append(t)
    assert sorted(chosen) == sorted(model.number)
    df = {t: sum(t in terms[i] for i in texts) for t in chosen}

    def vector(i):
        x = np.array([(1 + math.log(terms[i][t])) * (math.log((len(texts) + 1) / (df[t] + 1)) + 1) if terms[i][t] else 0.0 for t in chosen])
        return x / np.sqrt((x * x).sum()) if x.any() else x

    vectors = {i: vector(i) for i in texts}
    order = {r.id: n for n, r in enumerate(spark.range(400).orderBy(F.xxhash64("id"), "id").collect())}

    def vote(i, but=None):
        near = [(float(vectors[j] @ vectors[i]), j) for j in train if groups[j] != but and vectors[j] @ vectors[i] > 1e-12]
        if not near:
            return None
        near = sorted(near, key=lambda x: -round(x[0], 9))
        kth = round(near[min(5, len(near)) - 1][0], 9)
        sure, tied = [x for x in near if round(x[0], 9) > kth], [x for x in near if round(x[0], 9) == kth]
        return sure, tied, 5 - len(sure)

    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    place = {int(i): n for n, i in enumerate(model.ids)}
    votes = []
    for i in train:
        if (v := vote(i, groups[i])) is not None:
            sure, tied, left = v
            used = sure + sorted(tied, key=lambda x: place[x[1]])[:left]
            votes.append((sum(c * c * toxic[j] for c, j in used) / sum(c * c for c, _ in used), toxic[i]))
    levels, steps = isotonic([*votes, (0.0, 1), (1.0, 0)])
    without = [i for i in train if not vectors[i].any()]
    for i, r in got.items():
        v = vote(i)
        if v is None:
            assert r.score == pytest.approx(sum(toxic[j] for j in without) / (len(without) + 1)) and not r.neighbours
            continue
        sure, tied, left = v
        used = sure + sorted(tied, key=lambda x: place[x[1]])[:left]
        assert sorted(r.neighbours) == sorted(j for _, j in used) and sorted(r.cosines) == pytest.approx(sorted(c for c, _ in used), abs=1e-9)
        share = sum(c * c * toxic[j] for c, j in used) / sum(c * c for c, _ in used)
        at = max([k for k, s in enumerate(steps) if s <= share + 1e-12], default=0)
        assert r.score == pytest.approx(levels[at], abs=1e-9) and r.predicted == int(levels[at] >= 0.7)
    assert order and sum(r.predicted for r in got.values()) > 50


def test_toxicity_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (4, 1, None), (7, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score(odd(spark), toxicity.fit(odd(spark), labels))
    assert got.count() == 12 and got.where("score is null or held_out is null").isEmpty()
    model = toxicity.fit(odd(spark), labels.limit(0))
    assert {r.score for r in toxicity.score(odd(spark), model).collect()} == {0.0} and toxicity.score(empty(spark), model).isEmpty()
