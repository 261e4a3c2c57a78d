"""The pipeline's stages on odd rows and on the smallest tables, each checked on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.helpers import empty, odd
from tests.llm.test_operators import brute_groups, brute_hits
from tickspark.llm import decontaminate, line_dedup, ngram_join


def test_stages_on_odd_and_on_no_rows(spark, sf):
    for name, stage in P.STAGES:
        for docs in (odd(spark), empty(spark)):
            out = stage(spark, docs, sf)
            assert name == P.STAGES[-1][0] or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_each_stage_takes_effect_on_what_the_one_before_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(P.STAGES)
    calm = stages["toxicity"](spark, docs, sf).cache()
    assert 0 < calm.count() <= docs.count()
    lines = stages["line dedup"](spark, calm, sf).cache()
    assert lines.where(F.length("text") != F.col("n_chars")).isEmpty()
    wordless = F.coalesce(F.trim("text"), F.lit("")) == ""
    gone = calm.select("doc_id", "text").join(lines.select("doc_id"), "doc_id", "left_anti")
    emptied = {r.doc_id for r in line_dedup.dedup(calm).where((F.col("n_deleted") > 0) & wordless).collect()}
    assert {r.doc_id for r in gone.collect()} == emptied and lines.where(wordless).count() == calm.where(wordless).count()
    alone = stages["n-gram Jaccard join"](spark, lines, sf).cache()
    of = brute_groups([(r.doc_id, r.text, "") for r in lines.collect()], 5, 80, 100)  # all pairs of the stage's own input
    assert {r.doc_id for r in alone.collect()} == {i for i, (_, first) in of.items() if i == first}
    left = ngram_join.near_duplicates(alone)
    assert left.where("component_id <> doc_id").isEmpty()
    clean = stages["benchmark decontamination"](spark, alone, sf).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = brute_hits([(r.doc_id, r.text, "") for r in alone.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {i for i, (_, n, _) in hits.items() if not n}
    assert decontaminate.decontaminate(clean, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").isEmpty()
    mix = stages["mixing sources"](spark, clean, sf)
    assert mix.count() == clean.count() and mix.where("taken > 2 * size").isEmpty()


def test_run(spark, sf):
    assert P.run(spark, sf).count() > 0
