"""Exact top-k inner-product search by ball-tree branch and bound in shards.

Vectors become integers floor(scale * x). Each goes to the nearest of at most ``most_balls`` coarse balls, whose centres are fitted
on a sample of at most 16 rows a ball (fewer where vectors are long: 8,000,000 components); a ball of more than ``shard_rows`` is
dealt by a hash to several shards, so that a large group of copies is never one task. Each shard builds a ball tree. A node's
score is bounded by q . centre + |q| * radius, a coarse ball's also by |q| * its greatest norm. Queries go through a tree in
blocks: nodes in order of their bound, a query leaves a node whose bound is below its current kth score.

Queries go to shards in three rounds: their own shard; the ``near`` balls of greatest bound; the rest. After each round the kth
score found so far is shared, and a query is sent only to balls whose bound isn't below it. On vectors without structure nearly
all must be asked; the result is exact in any case.

Result: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Rows without vec_id, null vectors and vectors
with null or non-finite components take no part; only vectors of equal length are compared; a vec_id that repeats with the same
vector counts once, with different vectors each counts. A query's own vec_id is never a candidate. Scores are exact: in
float64 where 53 bits hold them, else in Python integers, and lie within 64 bits in the result. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import quiet_threads, stage

RESULT = "query_id long, rank int, vec_id long, score long"
_FOUND = "query_id long, vec_id long, score long"
_LEAST = 1 - (1 << 63)  # a score at or below it is cut to 64 bits, so it bounds nothing


def integers(rows: list, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; float64 if products' sums stay exact, else Python integers."""
    x = np.array(rows, np.float64).reshape(len(rows), -1)
    v = np.floor(x * scale)
    most = np.abs(v).max(initial=0)
    if np.isfinite(v).all() and most * most * max(1, v.shape[1]) < 2.0**52:
        return v
    exact = np.empty(x.shape, object)
    for i, row in enumerate(x):
        exact[i] = [int(c) * scale if abs(c) >= 2.0**53 else int(np.floor(c * scale)) for c in row.tolist()]
    return exact


class BallTree:
    """Nodes over vectors sorted into leaves; ``leaf`` vectors at most in each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 256) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.floats = self.vectors.astype(np.float64)
        self.nodes: list[tuple] = []  # centre, radius, least id, rows or None, children
        self.root = self._build(np.arange(len(ids)), leaf)

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        points = self.floats[rows]
        centre = points.mean(0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(1).max()))
        children: tuple = ()
        if len(rows) > leaf:
            # split at the median of the direction between two far points; equal points still fall into halves
            a = points[np.argmax(((points - centre) ** 2).sum(1))]
            b = points[np.argmax(((points - a) ** 2).sum(1))]
            order = np.argsort(points @ (b - a), kind="stable")
            half = len(rows) // 2
            children = (self._build(np.sort(rows[order[:half]]), leaf), self._build(np.sort(rows[order[half:]]), leaf))
        self.nodes.append((centre, radius, int(self.ids[rows[0]]), rows if not children else None, children))
        return len(self.nodes) - 1

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), queries x k, -inf where there is none; only what isn't below ``floor`` (a kth score so far)."""
        n = len(queries)
        exact = queries.dtype == object or self.vectors.dtype == object
        left = self.vectors.astype(object) if exact else self.vectors
        own = queries.astype(object) if exact else queries
        scores = np.full((n, k), -np.inf, object if exact else np.float64)
        ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        q = queries.astype(np.float64)
        norms = np.sqrt((q * q).sum(1))

        def bound(node: int, rows: np.ndarray) -> np.ndarray:
            centre, radius, *_ = self.nodes[node]
            b = q[rows] @ centre + norms[rows] * radius
            return b + 1e-9 * (np.abs(b) + norms[rows] * (np.sqrt((centre * centre).sum()) + radius)) + 1e-6

        def visit(node: int, rows: np.ndarray, bounds: np.ndarray) -> None:
            _, _, least_id, points, children = self.nodes[node]
            kth = np.maximum(scores[rows, k - 1].astype(np.float64), floor[rows])
            live = (bounds > kth) | (bounds == kth) & (least_id < ids[rows, k - 1])
            rows = rows[live]
            if not len(rows):
                return
            if points is None:
                pairs = [(bound(c, rows), c) for c in children]
                # the child with the greater bound first, query by query
                first = pairs[0][0] >= pairs[1][0]
                for order, mask in (((0, 1), first), ((1, 0), ~first)):
                    if mask.any():
                        for i in order:
                            visit(pairs[i][1], rows[mask], pairs[i][0][mask])
                return
            found = own[rows] @ left[points].T
            their = self.ids[points]
            kth = scores[rows, k - 1]
            own_row = their[None, :] == query_ids[rows][:, None]
            better = ((found > kth[:, None]) | (found == kth[:, None]) & (their[None, :] < ids[rows, k - 1][:, None])) & ~own_row & (found >= floor[rows][:, None])
            for i in np.flatnonzero(better.any(1)):
                at = np.flatnonzero(better[i])
                s = np.concatenate([scores[rows[i]], found[i, at]])
                d = np.concatenate([ids[rows[i]], their[at]])
                best = sorted(range(len(s)), key=lambda j: (-s[j], d[j]))[:k] if exact else np.lexsort((d, -s))[:k]
                scores[rows[i]], ids[rows[i]] = s[best], d[best]

        everyone = np.arange(n)
        visit(self.root, everyone, bound(self.root, everyone))
        return scores, ids


def _search(k: int, scale: int, block: int):
    def run(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        quiet_threads()
        out: list[list] = [[], [], []]
        if vectors.num_rows and queries.num_rows:
            tree = BallTree(vectors["vec_id"].to_numpy(), integers(vectors["vector"].to_pylist(), scale))
            query_ids = queries["vec_id"].to_numpy()
            own = integers(queries["vector"].to_pylist(), scale)
            floor = np.array([-np.inf if f is None or f <= _LEAST else float(f) for f in queries["floor"].to_pylist()])
            floor = floor - np.where(np.isfinite(floor), np.abs(floor) * 1e-15, 0)
            for at in range(0, len(own), block):
                scores, ids = tree.search(query_ids[at : at + block], own[at : at + block], floor[at : at + block], k)
                for i in range(len(scores)):
                    for s, d in zip(scores[i], ids[i], strict=True):
                        if s != -np.inf:
                            out[0].append(int(query_ids[at + i]))
                            out[1].append(int(d))
                            out[2].append(max(_LEAST, min((1 << 63) - 1, int(s))))
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return run


def fit_centres(points: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """At most ``n`` centres of ``points`` by Lloyd's rounds; one that loses its points stays. The first ones are drawn with weights
    of the squared distance from those there are, so that copies of one point give one centre."""
    draw = np.random.default_rng(0)
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < n and np.isfinite(far).all() and far.sum() > 0:
        chosen.append(int(np.searchsorted(np.cumsum(far), draw.random() * far.sum(), side="right").clip(0, len(points) - 1)))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    centres = points[chosen].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        size = np.bincount(near, minlength=len(centres))
        order = np.argsort(near, kind="stable")
        held = np.flatnonzero(size)
        centres[held] = np.add.reduceat(points[order], (np.cumsum(size) - size)[held]) / size[held, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray, block: int = 4096) -> np.ndarray:
    squares = (centres * centres).sum(1)
    parts = [np.argmin(squares - 2 * points[i : i + block] @ centres.T, axis=1) for i in range(0, len(points), block)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _matrix(column: pa.Array, rows: np.ndarray, scale: int) -> np.ndarray:
    """The vectors at ``rows`` (all of one length) as integers in float64."""
    picked = column.take(pa.array(rows))
    return integers(picked.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1), scale).astype(np.float64)


def _deal(centres: np.ndarray, scale: int):
    """Adds ball, distance from its centre and norm; vectors of another length than the centres' are in ball -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for b in batches:
            ball, distance, norm = np.full(b.num_rows, -1, np.int32), np.zeros(b.num_rows), np.zeros(b.num_rows)
            rows = np.flatnonzero(b.column("length").to_numpy() == centres.shape[1])
            if len(rows):
                with np.errstate(all="ignore"):
                    x = _matrix(b.column("vector"), rows, scale)
                    ball[rows] = nearest(x, centres)
                    distance[rows] = np.sqrt(((x - centres[ball[rows]]) ** 2).sum(1))
                    norm[rows] = np.sqrt((x * x).sum(1))
            yield pa.record_batch([*b.columns, pa.array(ball), pa.array(distance), pa.array(norm)], names=[*b.schema.names, "ball", "distance", "norm"])

    return run


def _ask(centres: np.ndarray, radius: np.ndarray, norm: np.ndarray, scale: int, near: int):
    """The balls whose bound isn't below a query's kth score: the ``near`` of greatest bound, and the rest with their bounds."""
    reach = np.sqrt((centres * centres).sum(1)) + radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for b in batches:
            first: list[list] = [[-1] for _ in range(b.num_rows)]
            rest: list[list] = [[] for _ in range(b.num_rows)]
            rows = np.flatnonzero(b.column("length").to_numpy() == centres.shape[1])
            if len(rows):
                with np.errstate(all="ignore"):
                    q = _matrix(b.column("vector"), rows, scale)
                    size = np.sqrt((q * q).sum(1))[:, None]
                    bounds = np.minimum(q @ centres.T + size * radius, size * norm) + 1e-9 * size * reach + 1e-6
                floors = b.column("floor").take(pa.array(rows)).to_pylist()
                for i, own, floor in zip(rows.tolist(), bounds, floors, strict=True):
                    order = np.argsort(-own, kind="stable")
                    if floor is not None and floor > _LEAST:
                        order = order[~(own[order] < floor)]
                    first[i] = order[:near].tolist()
                    rest[i] = [{"ball": int(j), "bound": float(own[j])} for j in order[near:]]
            kinds = pa.list_(pa.int32()), pa.list_(pa.struct([("ball", pa.int32()), ("bound", pa.float64())]))
            yield pa.record_batch([*b.columns, pa.array(first, kinds[0]), pa.array(rest, kinds[1])], names=[*b.schema.names, "near", "rest"])

    return run


def _kth(found: DataFrame, k: int) -> DataFrame:
    """The kth score of each query so far, null if there are fewer."""
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list("score"), asc=False), k, 1).alias("best"))
    return best.select(F.col("query_id").alias("vec_id"), F.try_element_at("best", F.lit(1)).alias("floor"))


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = 256, shard_rows: int = 20_000, block: int = 512, most_balls: int = 1024, near: int = 4, sent: list | None = None) -> DataFrame:
    """The ``k`` best candidates of each row for which ``is_query`` (over column vec_id) holds. ``sent``: a list that gets each
    round's table of queries per shard."""
    spark = embeddings.sparkSession
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(~bad).dropDuplicates(["vec_id", "vector"])
    rows = stage(rows.withColumn("length", F.size("vector")), "vectors")
    wanted = min(most_balls, -(-rows.count() // shard_rows))
    centres = np.zeros((1, 0))
    if wanted > 1:
        lengths = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
        least = F.xxhash64("vec_id")
        sample = rows.where(F.col("length") == lengths["length"]).orderBy(least, "vec_id").limit(min(16 * wanted, max(wanted, 8_000_000 // max(1, lengths["length"]))))
        with np.errstate(all="ignore"):
            centres = fit_centres(integers([r["vector"] for r in sample.select("vector").collect()], scale).astype(np.float64), wanted)
    dealt = stage(rows.mapInArrow(_deal(centres, scale), "vec_id long, vector array<double>, length int, ball int, distance double, norm double"), "dealt")
    # a row per ball, at most most_balls + 1
    balls = {r["ball"]: r for r in dealt.groupBy("ball").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.max("norm").alias("norm")).collect()}
    parts = F.broadcast(spark.createDataFrame([(b, -(-r["n"] // shard_rows)) for b, r in balls.items()], "ball int, parts int"))
    keys = ["length", "ball", "part"]
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    vectors = dealt.select("length", "ball", "vec_id", "vector").join(parts, "ball").withColumn("part", part).select(*keys, "vec_id", "vector").groupBy(*keys)
    search = _search(k, scale, block)

    def look(asked: DataFrame, name: str) -> DataFrame:
        asked = asked.select(*keys, "vec_id", "vector", "floor")
        if sent is not None:
            sent.append(asked)
        return stage(vectors.cogroup(asked.groupBy(*keys)).applyInArrow(search, _FOUND), name)

    # a table of its own: no attribute is shared with the vectors
    own = F.col("ball").alias("own_ball"), part.alias("own_part")
    queries = stage(dealt.where(is_query).join(parts, "ball").select("vec_id", "length", "vector", *own), "queries")
    found = look(queries.withColumns({"ball": F.col("own_ball"), "part": F.col("own_part"), "floor": F.lit(None).cast("long")}), "own")
    if len(balls) > 1 or any(r["n"] > shard_rows for r in balls.values()):
        each = [balls.get(i) for i in range(len(centres))]
        radius, norm = (np.array([r[c] if r else 0.0 for r in each]) for c in ("radius", "norm"))
        schema = "vec_id long, length int, vector array<double>, own_ball int, own_part int, floor long, near array<int>, rest array<struct<ball: int, bound: double>>"
        names = ["vec_id", "length", "vector", "own_ball", "own_part", "floor"]
        asked = stage(queries.join(_kth(found, k), "vec_id", "left").select(*names).mapInArrow(_ask(centres, radius, norm, scale, near), schema), "asked")

        def shards(of: DataFrame) -> DataFrame:
            """Each shard of the balls asked but the one a query began with."""
            each = of.join(parts, "ball").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            return each.where((F.col("ball") != F.col("own_ball")) | (F.col("part") != F.col("own_part")))

        found = found.unionByName(look(shards(asked.withColumn("ball", F.explode("near"))), "near"))
        rest = asked.drop("floor", "near").join(_kth(found, k), "vec_id", "left").withColumn("x", F.explode("rest"))
        rest = rest.where(F.col("floor").isNull() | (F.col("floor") <= _LEAST) | ~(F.col("x.bound") < F.col("floor"))).withColumn("ball", F.col("x.ball")).drop("x", "rest")
        if len(centres) > near:
            found = found.unionByName(look(shards(rest), "rest"))
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
