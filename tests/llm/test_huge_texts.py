"""Every corpus operator on texts of 10^6 blanks, letters and lines."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.helpers import frame
from tests.llm.test_operators import VOCABULARY
from tickspark.llm import byte_bpe, decontaminate, katz, line_dedup, media, mixing, ngram_join, quality, spelling, token_rollup, toxicity

N = 1_000_000


@pytest.fixture(scope="module")
def huge(spark):
    path = P.scratch(spark, "huge")
    texts = [" " * N + "a", "q" * N, "!" * N, "x\n" * N, "some words here " * 3]
    frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def items(spark):
    return spark.createDataFrame([("i", "ten words that no text of this test holds at all here")], "item_id string, text string")


def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "media": lambda spark, d: media.media_columns(d),
    "katz": lambda spark, d: katz.score(d),
    "ngram_join": lambda spark, d: ngram_join.near_duplicates(d, 4, (85, 100)),
    "line_dedup": lambda spark, d: line_dedup.dedup(d),
    "quality": lambda spark, d: quality.score(d, *quality.fit(d)),
    "mixing": lambda spark, d: mixing.mix(d, spark.createDataFrame([], "doc_id long, weight double")),
    "decontaminate": lambda spark, d: decontaminate.decontaminate(d, items(spark)),
    "toxicity": lambda spark, d: toxicity.score(d, toxicity.fit(d, labels(spark))),
    "byte_bpe": lambda spark, d: byte_bpe.decode(byte_bpe.encode(d, VOCABULARY), VOCABULARY),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_an_operator_on_huge_texts(spark, huge, name):
    out = OPERATORS[name](spark, huge)
    assert out.select(F.bit_xor(F.xxhash64(*[c for c, t in out.dtypes if not t.startswith("map")])), F.count("*")).first()[1] == 5


def test_tokens_of_huge_texts(spark, huge):
    counted = {(r.doc_id, r.tokenizer): r.n_tokens for r in token_rollup.count_tokens(huge, VOCABULARY, "bpe").collect()}
    short = {(r.doc_id, r.tokenizer): r.n_tokens for r in token_rollup.count_tokens(huge.withColumn("text", F.substring("text", 1, 4000)), VOCABULARY, "bpe").collect()}
    assert counted[0, "bpe"] == N and counted[3, "bpe"] == 2 * N and counted[1, "words-1"] == counted[2, "words-1"] == 1
    for i in (1, 2):
        assert counted[i, "bpe"] == pytest.approx(short[i, "bpe"] * N / 4000, rel=0.01)


def test_words_of_huge_texts(spark, huge):
    assert spelling.variants(huge).isEmpty()  # no run of letters occurs five times
