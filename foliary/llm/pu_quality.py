"""Quality classifier learned from positive and unlabelled texts.

Trusted positives are texts labelled 1; all other texts are unlabelled web text. A first classifier of positives against
unlabelled texts gives an estimate of the share of positives among the unlabelled (the ratio of the masses
above the threshold where ratio and spread are least). The final classifier, logistic over standardised style features, squares and products, minimises the
non-negative unbiased risk prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

The fit is over a bounded sample: ``fit_rows`` texts of either kind, those of least hashed doc_id. Without positives or
unlabelled texts every score is 0.5. Scoring reads each whole text once, without a shuffle. Null texts are empty texts and get
a score too. Labels that are null or repeated don't fail: a doc_id counts as positive if any of its labels is 1. Repeated rows
get equal scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import held_out, quiet_threads, slices, stage, texts
from foliary.llm.words import STYLE, style

SCORES = "doc_id long, score double"


def spread(x: np.ndarray) -> np.ndarray:
    """Features and their squares and products."""
    i, j = np.triu_indices(x.shape[1])
    return np.column_stack([x, x[:, i] * x[:, j]])


class Logistic:
    """Standardised, spread features and a weight each."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights

    def margins(self, x: np.ndarray) -> np.ndarray:
        z = spread(np.clip((x - self.mean) / self.scale, -4, 4))
        return np.column_stack([np.ones(len(z)), z]) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _descend(gradient, n: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam."""
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least_mass: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores: the ratio of masses above a threshold, at the threshold where
    the ratio and its spread together are least."""
    best, at_best = np.inf, 1.0
    for t in np.quantile(positive, np.linspace(0.02, 1 - least_mass, 60)):
        p, u = (positive >= t).mean(), (unlabelled >= t).mean()
        if p >= least_mass:
            bound = u / p + np.sqrt(np.log(100) / 2) * (1 / np.sqrt(len(unlabelled)) + u / p / np.sqrt(len(positive))) / p
            if bound < best:
                best, at_best = bound, u / p
    return float(np.clip(at_best, 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 500, decay: float = 1e-3) -> tuple[Logistic, float]:
    """The classifier and the estimated prior."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    z = [np.column_stack([np.ones(len(x)), spread(np.clip((x - mean) / scale, -4, 4))]) for x in (positive, unlabelled)]
    sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(m, -30, 30)))
    n = z[0].shape[1]
    first = _descend(lambda w: -(z[0] * (1 - sigmoid(z[0] @ w))[:, None]).mean(0) + (z[1] * sigmoid(z[1] @ w)[:, None]).mean(0) + decay * w, n, 200)
    prior = estimate_prior(z[0] @ first, z[1] @ first)

    def gradient(w: np.ndarray) -> np.ndarray:
        p, u = z[0] @ w, z[1] @ w
        plus = -prior * (z[0] * (1 - sigmoid(p))[:, None]).mean(0)
        risk = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        minus = (z[1] * sigmoid(u)[:, None]).mean(0) - prior * (z[0] * sigmoid(p)[:, None]).mean(0)
        # where the negative risk falls below 0 its gradient is followed upwards instead
        return (plus + minus if risk >= 0 else -minus) + decay * w

    return Logistic(mean, scale, _descend(gradient, n, steps)), prior


def _style_rows(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4_000_000):
                part = batch.slice(start, stop - start)
                yield pa.record_batch([part.column("doc_id"), pa.array(list(style(part.column("text"))), pa.list_(pa.float64()))], names=["doc_id", "features"])

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, fit_rows: int = 6000) -> tuple[Logistic | None, float]:
    """Fit on at most ``fit_rows`` positives and ``fit_rows`` unlabelled texts, all of them outside the held-out fold."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder)).groupBy("doc_id").agg(F.max("label").alias("label")).where("label = 1")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).withColumn("positive", F.lit(1))
    rows = texts(docs).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    any_ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(fit_rows).withColumn("positive", F.lit(0))
    ids = stage(chosen.select("doc_id", "positive").unionByName(any_ids), "fit-ids")
    sample = stage(_style_rows(rows.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").dropDuplicates(["doc_id"])), "fit-rows").join(F.broadcast(ids), "doc_id")
    found = sample.select("positive", "features").toPandas()
    x = np.array(found["features"].tolist(), np.float64).reshape(len(found), len(STYLE))
    flag = found["positive"].to_numpy() == 1
    if not flag.any() or flag.all():
        return None, 0.5
    return fit(x[flag], x[~flag])


def score(docs: DataFrame, model: Logistic | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4_000_000):
                part = batch.slice(start, stop - start)
                found = np.full(part.num_rows, 0.5) if model is None else model.scores(style(part.column("text")))
                yield pa.record_batch([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, SCORES)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5, remainder: int = 0, fit_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model, _ = train(docs, labels, modulus, remainder, fit_rows)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def with_scores(docs: DataFrame, model: Logistic | None, name: str) -> DataFrame:
    """All columns of ``docs`` and the score of column text under ``name``: rows stay where they are."""
    from pyspark.sql.types import DoubleType, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for start, stop in slices(batch.column(at), 4_000_000):
                part = batch.slice(start, stop - start)
                found = np.full(part.num_rows, 0.5) if model is None else model.scores(style(part.column(at)))
                yield pa.record_batch([*part.columns, pa.array(found)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))
