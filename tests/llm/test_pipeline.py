"""The pipeline against its parts, on a small table."""

import corpus_pipeline
from foliary.llm import chosen_path, pu_quality, weak_toxicity
from foliary.llm.common import stage, table


def test_stages_chain_and_take_effect(spark, small):
    docs = table(spark, small, "documents")
    labels = table(spark, small, "labels")
    quality = {r.doc_id for r in pu_quality.classify(docs, labels).where("predicted = 1").collect()}
    kept = stage(corpus_pipeline.good_quality(spark, docs, small), "t")
    assert {r.doc_id for r in kept.collect()} == quality and kept.columns == docs.columns
    clean = {r.doc_id for r in weak_toxicity.classify(kept, labels).where("predicted = 0").collect()}
    kept = stage(corpus_pipeline.not_toxic(spark, kept, small), "t")
    assert {r.doc_id for r in kept.collect()} == clean and kept.columns == docs.columns
    classes = {r.class_id for r in chosen_path.similarity_join(kept).collect()}
    kept = stage(corpus_pipeline.one_of_each(spark, kept, small), "t")
    assert {r.doc_id for r in kept.collect()} == classes and kept.columns == docs.columns
    last = corpus_pipeline.packed(spark, kept, small).collect()
    assert {r.doc_id for r in last} == classes
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, last))


def test_pipeline_on_an_empty_table(spark, small, tmp_path):
    docs = table(spark, small, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, small), "t")
        assert docs.count() == 0


def test_odd_rows_and_clashing_names(spark, small):
    from pyspark.sql import functions as F

    docs = table(spark, small, "documents").limit(60)
    odd = docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    docs = stage(docs.unionByName(odd).unionByName(docs.limit(3)).withColumn("_score", F.lit("own")).withColumn("sid", F.lit(1)).withColumn("label", F.lit(None).cast("int")), "t")
    rows = docs.count()
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept = stage(function(spark, docs, small), "t")
        assert kept.columns == docs.columns and kept.count() <= docs.count() and kept.where("_score <> 'own' OR sid <> 1").count() == 0
        docs = kept
    assert 0 < docs.count() <= rows - 3 and docs.groupBy("doc_id").count().where("count > 1").count() == 0
    pieces = corpus_pipeline.packed(spark, docs, small)
    assert pieces.where("piece = 0").count() == docs.count()
