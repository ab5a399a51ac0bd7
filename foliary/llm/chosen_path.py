"""N-gram Jaccard self-join by chosen paths.

A text is the set of its shingles: ``width`` words in a row, lower-case and without signs at their ends (fewer words: one
shingle; no words: the text itself). Texts of equal sets are one class from the start. Then, in several runs:

1. sets split on a sampled shared token, the shingle least under the run's hash function; buckets above ``bucket`` sets split
   again on paths of twice as many sampled tokens, ``depth`` at most;
2. buckets are compared in full by sketches of the sets (equal shares of min-hash values), with a margin below the threshold:
   first in blocks, dealt anew for each bucket; then those of several blocks whose sets aren't of one family by then, in pairs
   of blocks;
3. runs repeat until a pair at the threshold has met with probability ``recall``: first as many as paths of one token need, then,
   for the sets that stood in a bucket that was split, as many more with fresh hash functions as paths of ``depth`` tokens need;
   the pairs that remain bind sets to families. Buckets of one family alone need no further comparison.

Sets of a family are then compared exactly, all with all, in blocks and then pairs of blocks; links are counted where they are
found, and of them only a spanning forest is kept: inside the blocks first, then between what these have joined. No bucket,
family or partner is capped, and no pair list leaves a task.

Result, a row per input row: doc_id, class_id (least doc_id of the texts linked to it directly or over others), copy_id (least
doc_id with an equal set), n_links (different sets of similarity at or above the threshold), n_copies, set_id (a digest of the
set) and class_set (the least set_id of the class). Null texts are empty texts; all empty texts are copies of each other. Rows
without doc_id take part like others; where a class has no other rows, its class_id is null. Extra columns are ignored; an
empty table gives an empty result. Sets are known by 64-bit digests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import quiet_threads, slices, stage, texts
from foliary.llm.words import Words

SKETCH = 32
_HALF = SKETCH // 2
_BROADCAST_ROWS = 500_000  # ids of 8 bytes: at most some 20 MB are broadcast, more are joined by a shuffle


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(array: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct shingles as sorted 64-bit hashes."""
    w = Words(array)
    names = w.dictionary.to_pylist()
    word_hash = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in names), np.uint64, len(names))
    full = np.fromiter((bool(x) for x in names), bool, len(names))
    keep = full[w.codes] if len(w.codes) else np.zeros(0, bool)
    h, doc = word_hash[w.codes[keep]] if len(names) else np.zeros(0, np.uint64), w.doc[keep]
    counts = np.bincount(doc, minlength=w.n)
    with np.errstate(over="ignore"):
        k = np.uint64(0x9E3779B97F4A7C15)
        n = len(h) - width + 1
        if n > 0:
            s = h[:n].copy()
            for j in range(1, width):
                s = s * k + h[j : j + n]
            inside = doc[:n] == doc[width - 1 :]
            s, owner = _mix(s[inside]), doc[:n][inside]
        else:
            s, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero(counts < width)
        if len(short):
            starts = np.cumsum(counts) - counts
            own = []
            for i in short.tolist():
                x = np.uint64(counts[i] + 1)
                if counts[i]:
                    for y in h[starts[i] : starts[i] + counts[i]]:
                        x = x * k + y
                else:
                    x = np.uint64(xxhash.xxh3_64_intdigest(w.texts[i].as_py(), 7))
                own.append(x)
            s, owner = np.concatenate([s, _mix(np.array(own, np.uint64))]), np.concatenate([owner, short])
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[first], owner[first]
    return s, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=w.n))])


def digests(s: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An order-free 64-bit digest of each set (no set is empty)."""
    with np.errstate(over="ignore"):
        return _mix(np.add.reduceat(_mix(s ^ np.uint64(0x51ED270B)), ends[:-1]) + np.diff(ends).astype(np.uint64)) if len(ends) > 1 else np.zeros(0, np.uint64)


def sketches(s: np.ndarray, ends: np.ndarray, first: int = 0, last: int = SKETCH) -> np.ndarray:
    """Sets x (last - first) min-hash values of 32 bits, of the hash functions first to last - 1."""
    out = np.zeros((len(ends) - 1, last - first), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(first, last if len(ends) > 1 else first):
            a = np.uint64((2 * i + 1) * 0xD1342543DE82EF95 % (1 << 64))
            v = (s ^ (a >> np.uint64(7))) * (a | np.uint64(1))
            v = ((v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
            out[:, i - first] = np.minimum.reduceat(v, ends[:-1])
    return out


def runs_needed(threshold: float, recall: float) -> int:
    """So many runs that a pair at the threshold shares a path of one token in one of them."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold)))


def more_runs(threshold: float, recall: float, runs: int, depth: int) -> int:
    """So many runs after the first ones that a pair of sets from split buckets is lost with the probability that remains. A
    pair is lost if it never met at a first token, (1 - t)^runs, or met there in split buckets and then shared no whole path
    in any run, at most (1 - t^depth)^(runs + more)."""
    rest = max(1 - recall - (1 - threshold) ** runs, (1 - recall) / 10)
    return max(0, math.ceil(math.log(rest) / math.log(1 - threshold**depth)) - runs)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows of one key, from batches sorted by it."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = [0, *edges.tolist(), batch.num_rows]
        for i in range(len(edges) - 1):
            part = batch.slice(edges[i], edges[i + 1] - edges[i])
            if kept and kept[0].column(key)[0].as_py() != int(keys[edges[i]]):
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(part)
    if kept:
        yield pa.Table.from_batches(kept)


def _labels(near: np.ndarray) -> np.ndarray:
    """Least member of each member's component under a symmetric relation."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(1)
        new = np.minimum(label, new)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _small(df: DataFrame, rows: int = _BROADCAST_ROWS) -> bool:
    return df.count() <= rows


def in_blocks(rows: DataFrame, sizes: DataFrame, key: str, size: int) -> DataFrame:
    """Adds ``blocks`` (how many the key's rows are dealt to) and ``own`` (a row's block, other ones for other keys). sizes: a
    staged table of (key, size); keys that it doesn't have vanish. It is broadcast if it is small: no row is then dealt by key."""
    joined = rows.join(F.broadcast(sizes) if _small(sizes) else sizes, key)
    joined = joined.withColumn("blocks", F.ceil(F.col("size") / size).cast("int")).drop("size")
    return joined.withColumn("own", F.pmod(F.xxhash64("sid", key, F.lit(11)), F.col("blocks")).cast("int"))


def in_pairs(rows: DataFrame, key: str) -> DataFrame:
    """Rows of keys with several blocks go to every pair of their block with another; ``place`` is the pair's key, ``side``
    the block's place in the pair."""
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != F.col("own"))
    spread = rows.where("blocks > 1").withColumn("other", F.explode(others))
    place = F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))
    return spread.withColumn("place", place).withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("blocks", "own", "other")


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span what ``near`` (left x right) joins of the labels ``left`` and ``right``."""
    i, j = np.nonzero(near & (left[:, None] != right[None, :]))
    pairs = np.unique(np.column_stack([left[i], right[j]]), axis=0).tolist()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.setdefault(x, x)) != x:
            root[x] = x = root[y] if y in root else y
        return x

    out = []
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _sketch_of(group: pa.Table) -> np.ndarray:
    return np.column_stack([group[f"k{i}"].to_numpy() for i in range(_HALF)]).view(np.uint32)


def _alike(left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    near = np.empty((len(left), len(right)), bool)
    for at in range(0, len(left), 64):
        near[at : at + 64] = (left[at : at + 64, None, :] == right[None, :, :]).sum(2) >= least
    return near


def candidate_edges(reps: DataFrame, active: DataFrame, depth: int, bucket: int, least: int, block: int = 512) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b): sets of one block whose sketches have ``least`` equal values, as forests; the sets (sid) of buckets that were
    split at the first token; and the rows (path, blocks, own, sid) of buckets of several blocks, whose pairs are still to be
    compared. active: sid, family, run, tokens; buckets of one family alone vanish."""
    active = active.select("sid", "family", "tokens", F.xxhash64("run", F.element_at("tokens", 1)).alias("path"))
    done, counted, split = [], [], None
    length = 1
    while True:
        sizes = active.groupBy("path").agg(F.count("*").alias("size"), F.min("family").alias("low"), F.max("family").alias("high")).where("size > 1 AND low <> high").select("path", "size")
        sizes = stage(sizes, f"sizes{length}")
        large = sizes.where(F.col("size") > bucket)
        counted.append(sizes if length == depth else sizes.where(F.col("size") <= bucket))
        done.append(active.select("sid", "path"))
        if length == depth or not large.limit(1).count():
            break
        met = stage(active.join(F.broadcast(large) if _small(large) else large, "path"), f"level{length}")
        split = met.select("sid").distinct() if split is None else split
        longer = min(2 * length, depth)  # a path of twice the tokens: fewer rounds for hot tokens
        active = met.select("sid", "family", "tokens", F.xxhash64("path", *(F.element_at("tokens", i + 1) for i in range(length, longer))).alias("path"))
        length = longer
    placed = None
    for rows, sizes in zip(done, counted, strict=True):
        own = in_blocks(rows, sizes, "path", block)
        placed = own if placed is None else placed.unionByName(own)
    names = [f"k{i}" for i in range(_HALF)]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        a, b = [], []
        for group in _groups(batches, "place"):
            sid, sketch = group["sid"].to_numpy(), _sketch_of(group)
            if len(sid) == 2:
                if (sketch[0] == sketch[1]).sum() >= least and sid[0] != sid[1]:
                    a.append(int(sid[0]))
                    b.append(int(sid[1]))
                continue
            label = _labels(_alike(sketch, sketch, least)) if len(sid) > 1 else np.zeros(1, np.int64)
            for i in np.flatnonzero(label != np.arange(len(sid))):
                if sid[i] != sid[label[i]]:
                    a.append(int(sid[i]))
                    b.append(int(sid[label[i]]))
            if len(a) > 100_000:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    placed = stage(placed, "placed")
    blocks = placed.select(F.xxhash64("path", "own").alias("place"), "sid").join(reps.select("sid", *names), "sid").repartition("place").sortWithinPartitions("place")
    edges = stage(blocks.mapInArrow(inside, "a long, b long").distinct(), "edges")
    return edges, split if split is not None else reps.select("sid").limit(0), placed.where("blocks > 1")


def edges_between(reps: DataFrame, several: DataFrame, families: DataFrame, least: int) -> DataFrame | None:
    """(a, b) between families: near sets of different blocks of one bucket, as forests. Buckets whose sets are all of one family
    need no comparison; None if there are no others."""
    names = [f"k{i}" for i in range(_HALF)]

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for group in _groups(batches, "place"):
            side, family, sketch = group["side"].to_numpy(), group["family"].to_numpy(), _sketch_of(group)
            left, right = side == 0, side == 1
            if not left.any() or not right.any() or (family == family[0]).all():
                continue
            edges = np.array(_forest(_alike(sketch[left], sketch[right], least), family[left], family[right]), np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["a", "b"])

    several = several.join(families, "sid", "left").withColumn("family", F.coalesce("family", "sid"))
    several = stage(several, "several")
    mixed = stage(several.groupBy("path").agg(F.min("family").alias("low"), F.max("family").alias("high")).where("low <> high").select("path"), "mixed")
    n_mixed = mixed.count()
    if not n_mixed:
        return None
    several = in_pairs(several.join(F.broadcast(mixed) if n_mixed <= _BROADCAST_ROWS else mixed, "path"), "path")
    pairs = several.select("place", "side", "sid", "family").join(reps.select("sid", *names), "sid").repartition("place").sortWithinPartitions("place")
    return stage(pairs.mapInArrow(between, "a long, b long").distinct(), "edges-between")


def merged(families: DataFrame, edges: DataFrame | None, name: str) -> DataFrame:
    """``families`` (sid, family: a component's least sid) after more edges: only what these join is followed."""
    if edges is None:
        return families
    of = lambda c: families.select(F.col("sid").alias(c), F.col("family").alias(f"f{c}"))
    mapped = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("fa", "a").alias("fa"), F.coalesce("fb", "b").alias("fb"))
    mapped = stage(mapped, f"{name}-mapped")
    across = mapped.where("fa <> fb").select(F.col("fa").alias("a"), F.col("fb").alias("b")).distinct()
    if not across.limit(1).count():
        return families  # an edge inside a family names no new set
    joined = components(across, name).select(F.col("sid").alias("family"), "root")
    ends = mapped.select(F.col("a").alias("sid"), F.col("fa").alias("family")).unionByName(mapped.select(F.col("b").alias("sid"), F.col("fb").alias("family")))
    every = families.unionByName(ends).distinct()
    return stage(every.join(joined, "family", "left").select("sid", F.coalesce("root", "family").alias("family")), f"{name}-families")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(sid, root): least node of each node's component. Labels are lowered over edges and then jump to their own label's
    label, until none changes; each round is staged."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("sid"), F.least("a", "m").alias("root")), f"{name}-0")
    step = 0
    while True:
        step += 1
        lowered = both.join(labels.select(F.col("sid").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        lowered = labels.join(lowered.withColumnRenamed("a", "sid"), "sid").select("sid", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = labels.select(F.col("sid").alias("root"), F.col("root").alias("next"))
        new = stage(lowered.join(jump, "root", "left").select("sid", "old", F.least("root", F.coalesce("next", "root")).alias("root")), f"{name}-{step}")
        changed = new.where("old <> root").limit(1).count()
        labels = new.select("sid", "root")
        if not changed:
            return labels


def exact_links(members: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(sid, n_links) and the classes (sid, family) that the links make, by exact comparison; members, a staged table: family,
    sid, shingles (binary)."""

    def sets_of(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        column = group["shingles"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in column]
        return sets, np.array([len(x) for x in sets], np.int64)

    def common(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
        """Sizes of the intersections; right None: of left with itself."""
        sets = left + (right or [])
        if len(sets) <= 6:
            return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right or left] for a in left], np.float64)
        tokens, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        shared = np.bincount(code, minlength=len(tokens)) > 1
        number = np.cumsum(shared) - 1
        use = shared[code]
        code, owner = number[code[use]], owner[use]
        by = np.argsort(code, kind="stable")
        code, owner = code[by], owner[by]
        wide = 1 << 14
        out = np.zeros((len(left), len(right if right is not None else left)), np.float64)
        for at in range(0, int(shared.sum()), wide):
            a, b = np.searchsorted(code, [at, at + wide])
            part = np.zeros((len(sets), wide), np.float32)
            part[owner[a:b], code[a:b] - at] = 1
            out += part[: len(left)] @ (part if right is None else part[len(left) :]).T
        if right is None:
            np.fill_diagonal(out, [len(x) for x in left])
        return out

    def near(both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return both >= threshold * (a[:, None] + b[None, :] - both) - 1e-9

    def rows(*columns) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.asarray(c, np.int64)) for c in columns], names=["sid", "links", "root"])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for group in _groups(batches, "place"):
            sid = group["sid"].to_numpy()
            _, first = np.unique(sid, return_index=True)  # a text may be read from several rows
            sid, group = sid[first], group.take(pa.array(first))
            sets, size = sets_of(group)
            found = near(common(sets, None), size, size)
            np.fill_diagonal(found, False)
            yield rows(sid, found.sum(1), sid[_labels(found)])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for group in _groups(batches, "place"):
            sid = group["sid"].to_numpy()
            _, first = np.unique(sid, return_index=True)
            group = group.take(pa.array(first))
            side = group["side"].to_numpy()
            parts = [group.filter(pa.array(side == i)) for i in (0, 1)]
            if not parts[0].num_rows or not parts[1].num_rows:
                continue
            (left, a), (right, b) = sets_of(parts[0]), sets_of(parts[1])
            found = near(common(left, right), a, b)
            own, other = (p["sid"].to_numpy() for p in parts)
            yield rows(np.concatenate([own, other]), np.concatenate([found.sum(1), found.sum(0)]), np.concatenate([own, other]))
            edges = np.array(_forest(found, *(p["root"].to_numpy() for p in parts)), np.int64).reshape(-1, 2)
            yield rows(edges[:, 0], np.zeros(len(edges)), edges[:, 1])

    sizes = stage(members.groupBy("family").agg(F.count("*").alias("size")), "family-sizes")
    placed = in_blocks(members, sizes, "family", block)
    own = placed.select(F.xxhash64("family", "own").alias("place"), "sid", "shingles").repartition("place").sortWithinPartitions("place")
    found = stage(own.mapInArrow(inside, "sid long, links long, root long"), "links")
    forest = lambda x: x.where("sid <> root").select(F.col("sid").alias("a"), F.col("root").alias("b"))
    classes = components(forest(found), "classes").select("sid", F.col("root").alias("family"))
    if sizes.where(F.col("size") > block).limit(1).count():
        pairs = in_pairs(placed, "family").join(classes.select("sid", F.col("family").alias("root")), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        pairs = pairs.select("place", "side", "sid", "root", "shingles").repartition("place").sortWithinPartitions("place")
        more = stage(pairs.mapInArrow(between, "sid long, links long, root long"), "links-between")
        classes = merged(classes, forest(more), "joined")
        found = found.unionByName(more)
    return found.groupBy("sid").agg(F.sum("links").alias("n_links")), classes


def similarity_join(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.9999, depth: int = 4, bucket: int = 128, margin: float = 0.25, block: int = 512) -> DataFrame:
    """See the module's description."""
    runs = runs_needed(threshold, recall)
    names = [f"k{i}" for i in range(_HALF)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 6_000_000):
                part = batch.slice(start, stop - start)
                s, ends = shingle_sets(part.column("text"), width)
                k = np.ascontiguousarray(sketches(s, ends)).view(np.int64)
                yield pa.record_batch([part.column("doc_id"), pa.array(digests(s, ends).view(np.int64)), *(pa.array(np.ascontiguousarray(k[:, i])) for i in range(_HALF))], names=["doc_id", "sid", *names])

    schema = "doc_id long, sid long, " + ", ".join(f"{x} long" for x in names)
    signed = stage(texts(docs).mapInArrow(sign, schema), "signed")
    reps = stage(signed.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), *(F.first(x).alias(x) for x in names)), "sets")
    value = lambda i: F.shiftrightunsigned(F.col(f"k{i // 2}"), 32 * (i % 2)).bitwiseAND(F.lit(0xFFFFFFFF))
    paths = F.array(*(F.struct(F.lit(r).alias("run"), F.array(*(value((r + runs * d) % SKETCH) for d in range(depth))).alias("tokens")) for r in range(runs)))
    active = reps.select("sid", F.col("sid").alias("family"), F.explode(paths).alias("p")).select("sid", "family", "p.run", "p.tokens")

    def with_sid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 6_000_000):
                part = batch.column("text").slice(start, stop - start)
                yield pa.record_batch([part, pa.array(digests(*shingle_sets(part, width)).view(np.int64))], names=["text", "sid"])

    def read_again(wanted: DataFrame) -> DataFrame:
        """Texts of the sets in a staged table (sid, rep, family), with the sid they are wanted for: by doc_id, and where a set
        only has rows without one, by the set itself."""
        named = wanted.where("rep IS NOT NULL").select(F.col("rep").alias("doc_id"), "sid", "family")
        found = texts(docs).join(F.broadcast(named) if _small(named) else named, "doc_id").select("text", "sid", "family")
        nameless = wanted.where("rep IS NULL").select("sid", "family")
        if nameless.limit(1).count():
            own = texts(docs).where("doc_id IS NULL").mapInArrow(with_sid, "text string, sid long").dropDuplicates(["sid"])
            found = found.unionByName(own.join(nameless, "sid").select("text", "sid", "family"))
        return found

    least = int(math.floor((threshold - margin) * SKETCH))
    edges, split, several = candidate_edges(reps, active, depth, bucket, least)
    families = components(edges, "families").select("sid", F.col("root").alias("family"))
    split = stage(split.join(reps.select("sid", "rep"), "sid").join(families, "sid", "left").select("sid", "rep", F.coalesce("family", "sid").alias("family")), "split")
    more = more_runs(threshold, recall, runs, depth)
    n_split = split.count()
    if n_split and more:

        def with_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            quiet_threads()
            for batch in batches:
                for start, stop in slices(batch.column("text"), 6_000_000):
                    part = batch.slice(start, stop - start)
                    s, ends = shingle_sets(part.column("text"), width)
                    own = digests(s, ends).view(np.int64)
                    right = np.flatnonzero(own == part.column("sid").to_numpy())
                    fresh = sketches(s, ends, SKETCH, SKETCH + more * depth)[right].astype(np.int64)
                    tokens = pa.FixedSizeListArray.from_arrays(pa.array(fresh.ravel()), more * depth).cast(pa.list_(pa.int64()))
                    yield pa.record_batch([pa.array(own[right]), part.column("family").take(pa.array(right)), tokens], names=["sid", "family", "tokens"])

        fresh = read_again(split).mapInArrow(with_tokens, "sid long, family long, tokens array<long>")
        fresh = stage(fresh.dropDuplicates(["sid"]), "tokens")
        paths = F.array(*(F.struct(F.lit(runs + r).alias("run"), F.slice("tokens", r * depth + 1, depth).alias("tokens")) for r in range(more)))
        active = fresh.select("sid", "family", F.explode(paths).alias("p")).select("sid", "family", "p.run", "p.tokens")
        found, _, others = candidate_edges(reps, active, depth, bucket, least)
        families, several = merged(families, found, "more"), several.unionByName(others)
    if several.limit(1).count():
        families = merged(families, edges_between(reps, several, families, least), "between")
    wanted = stage(families.join(reps.select("sid", "rep"), "sid"), "wanted")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for start, stop in slices(batch.column("text"), 6_000_000):
                part = batch.slice(start, stop - start)
                s, ends = shingle_sets(part.column("text"), width)
                own = digests(s, ends).view(np.int64)
                right = np.flatnonzero(own == part.column("sid").to_numpy())
                raw = s.astype("<u8", copy=False)
                sets = [raw[ends[i] : ends[i + 1]].tobytes() for i in right.tolist()]
                yield pa.record_batch([part.column("family").take(pa.array(right)), pa.array(own[right]), pa.array(sets, pa.binary())], names=["family", "sid", "shingles"])

    members = read_again(wanted).mapInArrow(with_sets, "family long, sid long, shingles binary")
    linked, classes = exact_links(stage(members, "members"), threshold, block)
    named = classes.join(reps.select("sid", "rep"), "sid")
    least_id = named.groupBy("family").agg(F.min("rep").alias("class_id"))
    in_class = named.join(least_id, "family").select("sid", "class_id", F.col("family").alias("class_set"))
    of_set = reps.select("sid", "rep", "n_copies").join(in_class, "sid", "left").join(linked, "sid", "left")
    alone = F.col("class_set").isNull()
    of_set = of_set.select("sid", F.when(alone, F.col("rep")).otherwise(F.col("class_id")).alias("class_id"), F.col("rep").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies", F.coalesce("class_set", "sid").alias("class_set"))
    return signed.select("doc_id", "sid").join(of_set, "sid").select("doc_id", "class_id", "copy_id", "n_links", "n_copies", F.col("sid").alias("set_id"), "class_set")


def keep_one(docs: DataFrame, classes: DataFrame, width: int = 5) -> DataFrame:
    """One row of each class, with the least doc_id there is in it and all columns of ``docs``. ``classes``: similarity_join's
    rows for ``docs``, as a staged table. Rows stay where they are, but for those whose doc_id repeats or is null: their class is
    found by their set, and one row of those that remain of a class stays."""
    from pyspark.sql.types import LongType, StructType

    gone = classes.where("doc_id <> class_id").select("doc_id").distinct()
    kept = docs.join(F.broadcast(gone) if _small(gone) else gone, "doc_id", "left_anti")
    odd = stage(classes.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_foliary_id")), "odd-ids")
    if not odd.limit(1).count():
        return kept

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for start, stop in slices(batch.column(at), 6_000_000):
                part = batch.slice(start, stop - start)
                own = digests(*shingle_sets(part.column(at).cast(pa.string()), width)).view(np.int64)
                yield pa.record_batch([*part.columns, pa.array(own)], names=[*batch.schema.names, "_foliary_set"])

    odd = F.broadcast(odd) if _small(odd) else odd
    same = docs["doc_id"].cast("long").eqNullSafe(odd["_foliary_id"])
    doubted = docs.join(odd, same, "left_semi").mapInArrow(signed, StructType([*docs.schema.fields]).add("_foliary_set", LongType()))
    of_set = classes.select(F.col("set_id").alias("_foliary_set"), F.col("class_id").alias("_foliary_id"), F.col("class_set").alias("_foliary_class")).dropDuplicates(["_foliary_set"])
    doubted = doubted.join(of_set, "_foliary_set").where(F.col("doc_id").cast("long").eqNullSafe(F.col("_foliary_id"))).dropDuplicates(["_foliary_class"])
    return kept.join(odd, kept["doc_id"].cast("long").eqNullSafe(odd["_foliary_id"]), "left_anti").unionByName(doubted.select(*docs.columns))
