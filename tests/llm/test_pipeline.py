from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from rollstate.llm import line_dedup, packing, pipeline_stages, quality, queries
from rollstate.llm.common import read
from tests.llm.test_join import brute_force

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "packing"]
    machine = queries.quality_machine(docs, read(spark, SF, "labels", "doc_id", "quality"))
    good = {r.doc_id for r in quality.score(docs.select("doc_id", "text"), machine, 0.7).filter("predicted = 1").collect()}
    kept = pipeline_stages.keep_quality(spark, docs, SF).cache()
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == docs.columns
    cleaned = pipeline_stages.drop_boilerplate(spark, kept, SF).cache()
    want = {r.doc_id: r.text for r in line_dedup.drop_lines(kept).collect()}
    assert {r.doc_id: r.text for r in cleaned.collect()} == want and cleaned.columns == docs.columns
    assert cleaned.filter(F.char_length("text") != F.col("n_chars")).count() == 0
    once = pipeline_stages.keep_one_of_each_group(spark, cleaned, SF).cache()
    classes = brute_force_classes(want)
    assert {r.doc_id for r in once.collect()} == classes and once.columns == docs.columns
    packed = pipeline_stages.pack_batches(spark, once, SF)
    assert {r.doc_id for r in packed.collect()} == classes
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in packed.collect()}


def brute_force_classes(texts):
    return {c for c, _, _ in brute_force(texts).values()}


def test_stages_on_edge_rows(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.char_length("text").cast("long").alias("n_chars"))
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:3]:
            out = stage(spark, rows, SF)
            assert out.columns == docs.columns and out.count() <= rows.count()
    once = pipeline_stages.keep_one_of_each_group(spark, docs, SF).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in once) == [0, 4, 5, 6, 7, 8, 9]  # empty texts and "one" once each
    assert packing.pack(docs, "doc_id", queries.word_count()).count() == docs.count()


def test_all_stages_on_edge_rows_without_usable_labels(spark, edge_docs, tmp_root):
    docs = edge_docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.char_length("text").cast("long").alias("n_chars"))
    for name, labels in (("none", []), ("ones", [(0, 1), (4, 1)]), ("zeros", [(0, 0), (4, 0)])):
        folder = f"{tmp_root}/{name}"
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        for rows in (docs, docs.limit(0)):
            assert pipeline_stages.keep_quality(spark, rows, folder).count() == rows.count()
    docs.write.parquet(f"{folder}/documents.parquet")
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in packed) == [0, 4, 5, 6, 7, 8, 9]


def test_unique_text_under_a_repeated_id_stays(spark):
    a, u = "a text that is here more than once under two ids", "another text that is here only once under a repeated id"
    docs = spark.createDataFrame([(1, a), (5, a), (5, u), (None, u + " and none")], "doc_id long, text string")
    docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    kept = {(r.doc_id, r.text) for r in pipeline_stages.keep_one_of_each_group(spark, docs, SF).collect()}
    assert kept == {(1, a), (5, u), (None, u + " and none")}
