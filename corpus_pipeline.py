"""Corpus pipeline over ``documents``: quality, toxicity, near duplicates, packing.

Each stage calls one operator of ``foliary.llm`` on all that its predecessor kept; ``run`` stages each result as Parquet in
the shared folder. All stages but the last return the columns of documents, whatever further ones there are and whatever their
names. Null texts are empty texts, which are scored like others; rows with null doc_id, repeated rows and repeated ids of different
texts are rows of their own for the classifiers. Of each class of copies one row stays, one with the least doc_id there is in it; ties
between rows of that id go to any one. Empty tables give empty tables; without labels the classifiers reject what their modules
say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import best_fit, chosen_path, pu_quality, weak_toxicity
from foliary.llm.common import stage, table

THRESHOLD = 0.3


def _kept(docs: DataFrame, scored, keep) -> DataFrame:
    """Rows of ``docs`` whose score, under a name that no column has, passes ``keep``."""
    taken, name = {c.lower() for c in docs.columns}, "_score"
    while name in taken:
        name = f"_{name}"
    return scored(docs, name).where(keep(F.col(name))).drop(name)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of at least 0.3)."""
    model, _ = pu_quality.train(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    return _kept(docs, lambda d, name: pu_quality.with_scores(d, model, name), lambda score: score >= THRESHOLD)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject (score below 0.3)."""
    model = weak_toxicity.train(docs, table(spark, sf_dir, "labels"), modulus=4, remainder=2)
    return _kept(docs, lambda d, name: weak_toxicity.with_scores(d, model, name), lambda score: score < THRESHOLD)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies (five words, similarity 0.8)."""
    return chosen_path.keep_one(docs, stage(chosen_path.similarity_join(docs, threshold=0.8, width=5), "class-ids"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2,048 tokens."""
    return best_fit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [("quality classifier", good_quality), ("toxicity", not_toxic), ("n-gram Jaccard join", one_of_each), ("best-fit packing", packed)]

#: SQL expresses none of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
