"""Approximate nearest neighbours by learned partitions.

Fit, on the driver, over bounded samples only: ``fit_rows`` rows (those of least hash) give a graph of nearest neighbours; the graph is cut
into equal parts, beginning with median splits and then moving nodes to the part that holds most of their neighbours while it has room; a
small network (one hidden layer) learns from a vector how its neighbours are spread over the parts. Then Spark does the work: every row
is assigned to its most probable part, every query is sent to its ``probes`` most probable ones, and these are reranked exactly.

``probes`` is measured, not guessed: up to ``tune_rows`` further rows, which the graph doesn't hold, are searched by brute force among the sample, and the
least number of parts is taken that finds a share ``recall`` of their neighbours (as many of ``k`` as fall to the sample's share of all rows).
Vectors without structure need most parts, clustered ones few.

A part is dealt in blocks of about ``block_rows`` rows and its queries in blocks of ``block_queries``, so that a part that holds a third of all rows, or gets as
many queries, is many tasks. Queries first search a block of their most probable part; the kth score found goes with them to the
others, which return only what can still count. Blocks are scored by matrix product; what is within rounding of the kth is scored again component by
component, in order, so that equal vectors have equal scores wherever they stand.

Vectors null, empty, zero or holding null or non-finite components, and rows without vec_id, take no part; only vectors of equal length are
compared. A vec_id that repeats with the same vector counts once, with different vectors each counts, and their answers as queries
are one list. A query's own vec_id is never a candidate. Ties go to the smaller vec_id. Scores that overflow to NaN are left out. Empty tables give empty
results.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.common import quiet_threads, stage

RESULT = "query_id long, rank int, vec_id long, score double"
_FOUND = "query_id long, vec_id long, score double"


class Model(NamedTuple):
    """A small network from a vector to the probabilities of the parts."""

    inner: np.ndarray
    outer: np.ndarray
    parts: int
    probes: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(_hidden(x, self.inner) @ self.outer)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    x = x / np.where(top == 0, 1, top)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm == 0, 1, norm)


def _hidden(x: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Directions beside what the hidden layer makes of them, and a constant."""
    u = _unit(x)
    return np.column_stack([u, np.maximum(u @ inner[:-1] + inner[-1], 0), np.ones(len(u))])


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def matrix(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of an Arrow list column, padded with zeros (or cut) to ``width``, and their lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(ends) and (ends == width).all():
        return values.reshape(-1, width), ends
    out = np.zeros((len(ends), width))
    start = np.cumsum(ends) - ends
    for i, n in enumerate(np.minimum(ends, width)):
        out[i, :n] = values[start[i] : start[i] + n]
    return out, ends


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None = None, block: int = 512) -> np.ndarray:
    """Places of each query's ``k`` greatest inner products; ``own`` is each query's own place among the rows."""
    out = np.zeros((len(queries), k), np.int64)
    for at in range(0, len(queries), block):
        s = queries[at : at + block] @ rows.T
        if own is not None:
            s[np.arange(len(s)), own[at : at + block]] = -np.inf
        out[at : at + block] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < s.shape[1] else np.argsort(-s, 1)[:, :k]
    return out


def partition(x: np.ndarray, graph: np.ndarray, parts: int, passes: int = 6, slack: float = 1.05) -> np.ndarray:
    """Nodes dealt to ``parts`` (a power of two) of at most ``slack`` times the mean size, with few edges between parts."""
    rng, n = np.random.default_rng(0), len(x)
    part = np.zeros(n, np.int64)
    for level in range(parts.bit_length() - 1):  # median splits: equal parts to begin with
        for p in range(1 << level):
            at = np.flatnonzero(part == p)
            if len(at) > 1:
                a = x[at[rng.integers(len(at))]]
                b = x[at[np.argmin(x[at] @ a)]]
                part[at[np.argsort(x[at] @ (b - a), kind="stable")[len(at) // 2 :]]] += 1 << level
    back = np.argsort(graph, axis=None, kind="stable")
    sources, ends = back // graph.shape[1], np.searchsorted(graph.ravel()[back], np.arange(n + 1))
    sizes, most = np.bincount(part, minlength=parts), int(np.ceil(slack * n / parts))
    for _ in range(passes):
        moved = 0
        for i in rng.permutation(n):
            near = np.bincount(part[np.concatenate([graph[i], sources[ends[i] : ends[i + 1]]])], minlength=parts)
            room = (sizes < most) | (np.arange(parts) == part[i])
            best = int(np.argmax(np.where(room, near, -1)))
            if near[best] > near[part[i]]:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def _learn(x: np.ndarray, target: np.ndarray, hidden: int, epochs: int, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer and output layer that minimise the cross-entropy to ``target``, by Adam."""
    rng = np.random.default_rng(0)
    inner = np.vstack([rng.normal(size=(x.shape[1], hidden)) * np.sqrt(2.0), np.zeros(hidden)])
    weights = [inner, np.zeros((x.shape[1] + hidden + 1, target.shape[1]))]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    u = _unit(x)
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            h = _hidden(u[rows], weights[0])
            wrong = (_softmax(h @ weights[1]) - target[rows]) / len(rows)
            active = h[:, x.shape[1] : -1] > 0
            down = (wrong @ weights[1][x.shape[1] : -1].T) * active
            grads = [np.vstack([u[rows].T @ down, down.sum(0)]), h.T @ wrong]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + rate * 1e-4 * w
    return weights[0], weights[1]


def fit(sample: np.ndarray, tune: np.ndarray, n_rows: int, parts: int, k: int, recall: float, neighbours: int = 12, hidden: int = 64, epochs: int = 30) -> Model:
    """The model of a sample; ``tune`` are further vectors (none: the sample's own)."""
    n = len(sample)
    if n <= 2 or parts < 2:
        return Model(np.zeros((sample.shape[1] + 1, 1)), np.zeros((sample.shape[1] + 2, 1)), 1, 1)
    graph = nearest(sample, sample, min(neighbours, n - 1), np.arange(n))
    part = partition(sample, graph, parts)
    near = np.zeros((n, parts))
    np.add.at(near, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0)
    near[np.arange(n), part] += 2.0
    inner, outer = _learn(sample, near / near.sum(1, keepdims=True), hidden, epochs)
    model = Model(inner, outer, parts, 1)
    # how far down a query's list of parts its neighbours lie
    home = model.probabilities(sample).argmax(1)
    queries, own = (tune, None) if len(tune) >= 100 else (sample[: len(sample)], np.arange(n))
    share = max(1, min(n - 1, int(np.ceil(k * n / max(n, n_rows)))))
    found = nearest(queries, sample, share, own)
    order = np.argsort(np.argsort(-model.probabilities(queries), 1, kind="stable"), 1)
    ranks = np.take_along_axis(order, home[found], 1).ravel()
    return model._replace(probes=int(np.searchsorted(np.cumsum(np.bincount(ranks, minlength=parts)) / len(ranks), recall)) + 1)


def _routed(model, width: int, probes: int):
    """Adds ``part``: the list of a vector's most probable parts."""

    def run(batches):
        quiet_threads()
        for batch in batches:
            x, _ = matrix(batch.column("vector"), width)
            p = model.value.probabilities(x) if len(x) else np.zeros((0, 1))
            top = np.argsort(-p, 1, kind="stable")[:, :probes]
            offsets = np.arange(0, top.size + 1, top.shape[1] if len(top) else 1, dtype=np.int32)[: len(top) + 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(top.ravel().astype(np.int32)))], names=[*batch.schema.names, "part"])

    return run


def _best(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, pairs: int = 1 << 18):
    """(query_id, vec_id, score) of each query's k best rows that can reach its floor; ``rows`` stand in order of ids."""
    with np.errstate(all="ignore"):
        scale = np.abs(queries).max(1, initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
        near = 1e-12 * scale
        step = max(1, pairs // max(1, len(rows)))
        for at in range(0, len(queries), step):
            q, low = queries[at : at + step], near[at : at + step]
            s = q @ rows.T
            s[ids[None, :] == query_ids[at : at + step, None]] = -np.inf
            s[np.isnan(s)] = -np.inf
            kth = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(q), -np.inf)
            i, j = np.nonzero((s >= np.maximum(kth, floor[at : at + step])[:, None] - low[:, None]) & (s > -np.inf))
            exact = np.zeros(len(i))
            for d in range(rows.shape[1]):
                exact += q[i, d] * rows[j, d]
            order = np.lexsort((ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            keep = (rank < k) & (exact >= floor[at : at + step][i])
            yield query_ids[at : at + step][i[keep]], ids[j[keep]], exact[keep]


def _search(k: int):
    def run(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        quiet_threads()
        out: list[list] = [[], [], []]
        if vectors.num_rows and queries.num_rows:
            width = key[0].as_py()
            vectors = vectors.sort_by("vec_id")
            rows, _ = matrix(vectors["vector"], width)
            own, _ = matrix(queries["vector"], width)
            floor = np.array([-np.inf if f is None else f for f in queries["floor"].to_pylist()])
            for found in _best(own, queries["vec_id"].to_numpy(), floor, rows, vectors["vec_id"].to_numpy(), k):
                for column, values in zip(out, found, strict=True):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(np.float64))], names=["query_id", "vec_id", "score"])

    return run


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector, length of the rows that take part, each once."""
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(~bad & F.exists("vector", lambda x: x != 0))
    return rows.dropDuplicates(["vec_id", "vector"]).withColumn("length", F.size("vector"))


def search(
    embeddings: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, fit_rows: int = 10_000, tune_rows: int = 1_000, part_rows: int = 2_000, least_parts: int = 16, most_parts: int = 256, block_rows: int = 4_096, block_queries: int = 1_024
) -> DataFrame:
    """The nearest found of each row for which ``is_query`` (over column vec_id) holds: query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    rows = stage(valid(embeddings), "vectors")
    n = rows.count()
    # bounded by fit_rows + tune_rows vectors, whatever the table
    drawn = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").select("vector", "length").limit(fit_rows + tune_rows).toArrow()
    lengths = drawn["length"].to_numpy()
    width = int(np.bincount(lengths).argmax()) if len(lengths) else 1
    sample = matrix(drawn["vector"], width)[0].astype(np.float64)
    parts = 1 << int(np.clip(np.round(np.log2(max(1, n / part_rows))), np.log2(least_parts), np.log2(most_parts)))
    model = fit(sample[:fit_rows], sample[fit_rows:], n, parts if n > 200 else 1, k, recall)
    shared = spark.sparkContext.broadcast(model)  # at most (width + 65) * most_parts numbers

    base = "vec_id long, vector array<double>, length int"
    index = rows.mapInArrow(_routed(shared, width, 1), f"{base}, part array<int>").withColumn("part", F.col("part")[0])
    index = stage(index, "index")
    queries = stage(rows.where(is_query).mapInArrow(_routed(shared, width, model.probes), f"{base}, part array<int>").withColumnRenamed("part", "parts"), "queries")
    probed = queries.select("vec_id", "vector", "length", F.posexplode("parts").alias("probe", "part"))
    keys = ["length", "part"]
    blocks = index.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    query_blocks = probed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("query_blocks"))
    sizes = stage(blocks.join(query_blocks, keys), "part-sizes")  # a row per part and length that is searched
    block = F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), "query_blocks").cast("int")
    # each block of rows meets each block of its part's queries
    dealt = index.join(sizes, keys).select(*keys, block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "vec_id", "vector")
    sent = probed.join(sizes, keys).select(*keys, query_block.alias("query_block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "probe", "vec_id", "vector")
    cell = [*keys, "block", "query_block"]
    nobody = F.lit(None).cast("double").alias("floor")
    home = (F.col("probe") == 0) & (F.col("block") == 0)
    run = lambda asked: dealt.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(_search(k), _FOUND)
    found = stage(run(sent.where(home).select(*cell, "vec_id", "vector", nobody)), "first")
    kth = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("best")).select(F.col("query_id").alias("vec_id"), F.try_element_at("best", F.lit(k)).alias("floor"))
    found = found.unionByName(run(sent.where(~home).join(kth, "vec_id", "left").select(*cell, "vec_id", "vector", "floor")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
