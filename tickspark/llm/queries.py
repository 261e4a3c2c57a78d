"""The registered query of each operator, with its production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm import byte_bpe, clustering, decontaminate, katz, line_dedup, media, mixing, ngram_join, quality, spelling, token_rollup, toxicity, url_filter
from tickspark.llm.common import cut, scratch, table

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH r(rule, host, path, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
h AS (SELECT n, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict FROM p, r
  WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN h USING (n)
"""


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come in; those labelled junk go; those labelled toxic move to a source of their own."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rollup = token_rollup.TokenRollup(spark, scratch(spark, "rollup"))
    counted = cut(token_rollup.count_tokens(docs, VOCABULARY, "byte-bpe-50k-1").withColumn("copy", F.monotonically_increasing_id()), "counts")  # every row counts
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rollup.commit(1, counted.withColumn("op", F.lit("insert")))
    rollup.commit(2, counted.join(marks.where("quality = 0"), "doc_id", "left_semi").withColumn("op", F.lit("delete")))
    rollup.commit(3, counted.join(marks.where("quality = 1 and toxic = 1"), "doc_id", "left_semi").withColumns({"op": F.lit("revise"), "source": F.lit("quarantine")}))
    return rollup.totals()


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, *quality.fit(docs)).select("doc_id", "votes", "posterior", "score", "keep")


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled good documents count twice, labelled junk half."""
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


OP8_SQL = r"""
WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS weight FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  -ln((CAST('0x' || substr(md5('8:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(weight, 1.0) AS k
  FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / weight AS level, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others FROM w),
a AS (SELECT *, rest / others AS t, row_number() OVER (ORDER BY level, rank) AS i FROM l),
f AS (SELECT *, min(CASE WHEN t < level THEN i END) OVER () AS first FROM a),
g AS (SELECT *, max(CASE WHEN i = first THEN t END) OVER () AS open FROM f),
p AS (SELECT source, source_size, CASE WHEN first IS NULL OR i < first THEN cap ELSE open * weight END AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM p),
o AS (SELECT d.*, source_size, target, epochs, floor(target - epochs * source_size)::BIGINT - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken, source, epochs FROM o
"""


def op3_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), 4, (85, 100))


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT n, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0),
x AS (SELECT DISTINCT n, array_to_string(w[s : s + 3], ' ') AS shingle FROM g),
z AS (SELECT n, count(*) AS size FROM x GROUP BY n),
p AS (SELECT a.n AS a, b.n AS b, count(*) AS common FROM x a JOIN x b ON a.shingle = b.shingle AND a.n <> b.n GROUP BY a.n, b.n),
l AS (SELECT a, b FROM p JOIN z u ON u.n = a JOIN z v ON v.n = b WHERE 100 * common >= 85 * (u.size + v.size - common)),
r AS (SELECT n, n AS m FROM z UNION SELECT r.n, l.b FROM r JOIN l ON r.m = l.a),
c AS (SELECT r.n, min(d.doc_id) AS component_id FROM r JOIN d ON r.m = d.n GROUP BY r.n)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, CASE WHEN size IS NULL THEN doc_id ELSE component_id END AS component_id FROM d LEFT JOIN z USING (n) LEFT JOIN c USING (n)
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, text, md5(coalesce(text, '')) AS t, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT n, doc_id, t, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d WHERE text IS NOT NULL),
w AS (SELECT n, doc_id, t, pos, md5(lower(trim(line))) AS h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
x AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY pos) AS i, sum(words) OVER (PARTITION BY n ORDER BY pos)::BIGINT AS e FROM w WHERE words > 0),
y AS (SELECT *, e - words AS s FROM x),
z AS (
  SELECT n, doc_id, t, string_agg(h, '') OVER f AS key, i AS first, max(i) OVER f AS last, max(e) OVER f - s >= 50 AS ok FROM y WINDOW f AS (PARTITION BY n ORDER BY s RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT n, doc_id, t, string_agg(h, '') OVER f, min(i) OVER f, i, e >= 50 FROM y WINDOW f AS (PARTITION BY n ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
p AS (SELECT *, first_value({'d': doc_id, 't': t, 'f': first, 'l': last}) OVER (PARTITION BY key ORDER BY doc_id NULLS LAST, t, first) AS o FROM z WHERE ok),
r AS (SELECT n, first, last FROM p WHERE (doc_id, t) IS DISTINCT FROM (o.d, o.t) OR first > o.l),
g AS (SELECT r.n, min(pos) AS a, max(pos) AS b FROM r JOIN y ON r.n = y.n AND y.i BETWEEN r.first AND r.last GROUP BY r.n, r.first, r.last),
k AS (SELECT l.n, l.pos, l.line, bool_or(g.n IS NOT NULL) AS gone FROM l LEFT JOIN g ON l.n = g.n AND l.pos BETWEEN a AND b GROUP BY l.n, l.pos, l.line),
c AS (SELECT n, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM k GROUP BY n)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, sha256(coalesce(c.text, '')) AS text_sha256 FROM d LEFT JOIN c USING (n)
"""


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
v AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[s : s + 9], ' ') AS win FROM p),
d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM v) WHERE len(w) >= k),
h AS (SELECT n, e.k, s, item FROM e JOIN v ON e.k = v.k AND array_to_string(w[s : s + e.k - 1], ' ') = win),
c AS (SELECT n, count(DISTINCT pos) AS n_hit FROM (SELECT n, unnest(range(s, s + k)) AS pos FROM (SELECT DISTINCT n, k, s FROM h)) GROUP BY n),
m AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT n, item FROM h) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (n) LEFT JOIN m USING (n)
"""

def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media.media_columns(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.col("length").alias("media_bytes"), "media_sha256", "feature", "digest", "shard", "offset", "width", "height", "bit_depth")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted", "neighbours", "cosines")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = r"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
g AS (SELECT coalesce(doc_id::VARCHAR, 'null') || ':' || run AS key, run, count(*) AS k FROM r WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT run, k, list_transform(range(octet_length(encode(key))), lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT) AS bytes FROM g),
h AS (SELECT run, k, xor(4294967295, list_reduce(bytes, lambda c, x: list_reduce(range(8), lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(c, x)), 4294967295::BIGINT)) AS h FROM b),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
e AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
s AS (SELECT word, length(word) AS l, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS key FROM e),
d AS (SELECT DISTINCT e.word, v.word AS shorter FROM e JOIN v ON v.word = substr(e.word, 1, i - 1) || substr(e.word, i + 1)),
p AS (SELECT a.word AS a, b.word AS b FROM s a JOIN s b ON a.l = b.l AND a.i = b.i AND a.key = b.key AND a.word <> b.word UNION SELECT word, shorter FROM d UNION SELECT shorter, word FROM d),
q AS (SELECT a AS word, b, v.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS place FROM p JOIN v ON v.word = b),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN q.n >= 5 * v.n THEN b END AS form, CASE WHEN q.n >= 5 * v.n THEN q.n END AS form_n FROM v LEFT JOIN q ON v.word = q.word AND place = 1),
c AS (SELECT word, word AS root, form AS following FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.following)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN c ON c.word = f.word AND c.following IS NULL
"""


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, and decoded from the ids."""
    found = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).drop("text")
    found = byte_bpe.decode(found, VOCABULARY)
    return found.select("doc_id", byte_bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.report(*clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5))


def op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Every distance to every centroid, round by round."""
    steps = [
        r"""v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS c, v AS m FROM v ORDER BY c LIMIT {k})",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT n, vec_id, v, d.c, d.distance FROM (SELECT n, vec_id, v, min({{'distance': list_sum(list_transform(range(1, 65), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::BIGINT, 'c': c}}) AS d FROM v, c{i} GROUP BY n, vec_id, v))""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, j, sum(v[j]) AS s, count(*) AS k FROM a{i}, range(1, 65) t(j) GROUP BY c, j),
m{i} AS (SELECT c, list((s - ((s % k) + k) % k) // k ORDER BY j) AS m FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.m, c{i}.m)::BIGINT[] AS m FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_media_columns": op2_media_columns,
    "op3_katz_scores": op3_katz_scores,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_source_mix": op8_source_mix,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_centroids": op13_centroids,
}
ORACLES = {"op1_url_filter": OP1_SQL, "op4_ngram_jaccard": OP4_SQL, "op5_line_dedup": OP5_SQL, "op8_source_mix": OP8_SQL, "op9_decontamination": OP9_SQL, "op11_spelling_variants": OP11_SQL, "op13_centroids": op13_sql()}
