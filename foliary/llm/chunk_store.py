"""Content-addressed store of token-id streams.

Documents are encoded, an end id is appended, and a rolling hash over a window of ids cuts each stream into chunks, so that
equal passages give equal chunks wherever they stand. A store is a folder of Parquet tables:

* ``kind=chunk``: one row per distinct chunk, under its BLAKE2b-128 digest: ids as little-endian unsigned integers of
  ``width`` bytes (2 if the vocabulary allows, else 4);
* ``kind=doc``: as dealt out by the encoder, one row per document: digests and lengths of its chunks in order;
* ``recipes/kind=recipe``: the same rows in ascending doc_id order (ties: by content), each with its partition, page and start
  in it and the Merkle root of its digests; a page is ``PAGE`` documents in a row;
* ``recipes/kind=manifest``: a row per page: its start in the partition, documents, tokens and the Merkle root of its
  documents' roots;
* ``top``: the Merkle root of all partitions' roots (each that of its pages), with the sums of documents and tokens.

``write_store`` makes it. ``verify`` reads it back: chunks must match their digests, the chunks that were found must give their
document's root and number of ids, the documents' roots their page's root in the manifest, and the manifest the root on top;
anything else raises ValueError. ``reconstruct`` gives back the ids. Null texts are empty: a document of the end id alone.
Repeated rows are documents of their own that share all chunks. Rows without doc_id come first. Extra columns are ignored; an
empty table gives an empty store. Strings of special tokens in a text become their ids, as in the library's own encoding.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.common import give_back, quiet_threads, slices, texts, workspace
from foliary.llm.pieces import library_table, worker_table

DIGEST = 16
_MULTIPLIER = 0x9E3779B97F4A7C15
PAGE = 1024
_ROWS = "place long, digest binary, doc_id long, n_tokens long, sizes binary, payload binary, kind string"


def cut_points(ids: np.ndarray, ends: np.ndarray, window: int, mean: int, least: int, most: int) -> list[list[int]]:
    """For each document (ends: offsets of documents in ids, from 0) the offsets where its chunks end.

    A chunk ends after position i if the top bits of the hash of the ``window`` ids up to i are 0, but chunks have ``least``
    ids at least (the last of a document aside) and ``most`` at most."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        c = np.uint64(_MULTIPLIER)
        inverse = np.uint64(pow(_MULTIPLIER, -1, 1 << 64))
        n = len(ids)
        up = np.full(n, c, np.uint64)
        down = np.full(n, inverse, np.uint64)
        if n:
            up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        total = np.cumsum(x * up, dtype=np.uint64)
        rolled = total.copy()
        rolled[window:] -= total[:-window] if n > window else total[:0]
        rolled *= down
    bits = max(1, mean.bit_length() - 1)
    hits = np.flatnonzero((rolled >> np.uint64(64 - bits)) == 0) + 1
    out = []
    first = np.searchsorted(hits, ends[:-1] + window)
    last = np.searchsorted(hits, ends[1:])
    hits_list = hits.tolist()
    for start, stop, a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), first.tolist(), last.tolist(), strict=True):
        cuts, at = [], start
        for h in hits_list[a:b]:
            while h - at > most:
                at += most
                cuts.append(at)
            if h - at >= least:
                at = h
                cuts.append(at)
        while stop - at > most:
            at += most
            cuts.append(at)
        if stop > at or not cuts:
            cuts.append(stop)
        out.append(cuts)
    return out


def merkle_root(digests: list[bytes]) -> bytes:
    """Root of the binary tree over the digests; an odd node goes up as it is."""
    level = digests or [b"\0" * DIGEST]
    while len(level) > 1:
        paired = [hashlib.blake2b(a + b, digest_size=DIGEST).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = paired + ([level[-1]] if len(level) % 2 else [])
    return level[0]


def _split(joined: bytes) -> list[bytes]:
    return [joined[i : i + DIGEST] for i in range(0, len(joined), DIGEST)]


def _ragged(data, ends: np.ndarray) -> pa.Array:
    """A binary array over one buffer, without a copy; ends: offsets from 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def encode_chunks(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 2, window: int = 16, mean: int = 512, slice_bytes: int = 3_000_000) -> DataFrame:
    """Rows of kind ``chunk`` (a digest once per task and 200,000 chunks, with its payload) and of kind ``doc``; ``place``
    says where to deal them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads(keep_tables=True)
        table = worker_table(("byte", tokenizer_path), lambda: library_table(tokenizer_path))
        seen: set[bytes] = set()
        names = ["place", "digest", "doc_id", "n_tokens", "sizes", "payload", "kind"]
        none = lambda n, kind: pa.nulls(n, kind)
        for batch in batches:
            for start, stop in slices(batch.column("text"), slice_bytes):
                part = batch.slice(start, stop - start)
                ids, ends = table.encode_texts(part.column("text"))
                ids = np.insert(ids, ends[1:], end_id)
                if width == 2 and len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("ids need a store of width 4")
                ends = ends + np.arange(len(ends))
                cuts = cut_points(ids, ends, window, mean, mean // 8, mean * 8)
                bounds = np.fromiter((0, *(c for own in cuts for c in own)), np.int64)
                per_doc = np.concatenate([[0], np.cumsum([len(own) for own in cuts])]).astype(np.int64)
                packed = memoryview(ids.astype(f"<u{width}").tobytes())
                del ids
                edges = (bounds * width).tolist()
                found = [hashlib.blake2b(packed[a:b], digest_size=DIGEST).digest() for a, b in pairwise(edges)]
                new = []
                for i, digest in enumerate(found):
                    if digest not in seen:
                        seen.add(digest)
                        new.append(i)
                sizes = np.diff(bounds)
                joined = b"".join(found)
                place = np.frombuffer(joined, "<i8")[::2][new] if new else np.zeros(0, np.int64)
                yield pa.record_batch([pa.array(place), pa.array([found[i] for i in new], pa.binary()), none(len(new), pa.int64()), pa.array(sizes[new]), none(len(new), pa.binary()), pa.array([packed[edges[i] : edges[i + 1]] for i in new], pa.binary()), pa.array(["chunk"] * len(new), pa.string())], names=names)
                digests = _ragged(joined, per_doc * DIGEST)
                place = [zlib.crc32(b"%d" % doc_id if doc_id is not None else own) for doc_id, own in zip(part.column("doc_id").to_pylist(), digests.to_pylist(), strict=True)]
                yield pa.record_batch([pa.array(place, pa.int64()), digests, part.column("doc_id"), pa.array(np.diff(ends)), _ragged(sizes.astype("<u4"), per_doc * 4), none(len(cuts), pa.binary()), pa.array(["doc"] * len(cuts), pa.string())], names=names)
                if len(seen) > 200_000:
                    seen.clear()
            give_back()

    return texts(docs).mapInArrow(run, _ROWS)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by kind and digest, chunks that repeat the last digest go."""
    quiet_threads()
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        digest = batch.column("digest")
        same = np.zeros(batch.num_rows, bool)
        same[1:] = pc.equal(digest.slice(1), digest.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        same[0] = digest[0].as_py() == last
        last = digest[-1].as_py()
        doc = pc.equal(batch.column("kind"), "doc").to_numpy(zero_copy_only=False)
        yield batch.take(pa.array(np.flatnonzero(doc | ~same)))


_STORED = _ROWS.replace("place long, ", "")
_RECIPES = "doc_id long, n_docs long, n_tokens long, digests binary, sizes binary, root binary, part int, page long, start_in_part long, kind string"
_TOP = "root binary, n_docs long, n_tokens long"


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, width: int = 2) -> None:
    """One shuffle: chunks are dealt by digest and documents' rows by doc_id, so no place gathers what a hot chunk's users are."""
    spark = docs.sparkSession
    dealt = encode_chunks(docs, tokenizer_path, end_id, width).repartition(F.col("place")).sortWithinPartitions("kind", "digest")
    dealt.mapInArrow(_first_of_each, _ROWS).drop("place").write.partitionBy("kind").option("compression", "zstd").parquet(path)

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        quiet_threads()
        part, at, n_done, roots = TaskContext.get().partitionId(), 0, 0, []
        pages: list[list] = [[], [], [], [], []]  # documents, tokens, root, page, start
        tokens = first = 0

        def close() -> None:
            for column, value in zip(pages, (len(roots), tokens, merkle_root(roots), (n_done - 1) // PAGE, first), strict=True):
                column.append(value)

        for b in batches:
            n = b.column("n_tokens").to_numpy()
            starts = at + np.cumsum(n) - n
            own = [merkle_root(_split(d)) for d in b.column("digests").to_pylist()]
            for root, k, start in zip(own, n.tolist(), starts.tolist(), strict=True):
                if len(roots) == PAGE:
                    close()
                    roots, tokens, first = [], 0, start
                roots.append(root)
                tokens += k
                n_done += 1
            page = np.arange(n_done - b.num_rows, n_done) // PAGE
            at += int(n.sum())
            yield pa.record_batch([b.column("doc_id"), pa.array(np.ones(b.num_rows, np.int64)), b.column("n_tokens"), b.column("digests"), b.column("sizes"), pa.array(own, pa.binary()), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(page), pa.array(starts), pa.array(["recipe"] * b.num_rows, pa.string())], names=names)
        if roots:
            close()
        n = len(pages[0])
        yield pa.record_batch([pa.nulls(n, pa.int64()), pa.array(pages[0], pa.int64()), pa.array(pages[1], pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(pages[2], pa.binary()), pa.array([part] * n, pa.int32()), pa.array(pages[3], pa.int64()), pa.array(pages[4], pa.int64()), pa.array(["manifest"] * n, pa.string())], names=names)

    names = [x.split()[0] for x in _RECIPES.split(", ")]
    found = spark.read.schema(_STORED).parquet(path).where("kind = 'doc'").select("doc_id", "n_tokens", F.col("digest").alias("digests"), "sizes")
    found.repartitionByRange("doc_id", "digests").sortWithinPartitions("doc_id", "digests").mapInArrow(rooted, _RECIPES).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}-recipes")
    sums, root = _sums(spark, path)
    total = [(bytearray(root), sum(r.n_docs for r in sums), sum(r.n_tokens for r in sums))]
    spark.createDataFrame(total, _TOP).coalesce(1).write.parquet(f"{path}-top")


def _sums(spark: SparkSession, path: str):
    """(a row per recipe partition: documents, tokens, root; the root over the partitions' roots). Pages of a partition are
    as many as its documents / PAGE, partitions are as many as the shuffle made."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = [merkle_root([x["root"] for x in pages]) for pages in b.column("pages").to_pylist()]
            yield pa.record_batch([b.column("part"), b.column("n_docs"), b.column("n_tokens"), pa.array(roots, pa.binary())], names=["part", "n_docs", "n_tokens", "root"])

    pages = _read_recipes(spark, path).where("kind = 'manifest'")
    by_part = pages.groupBy("part").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("page", "root"))).alias("pages"))
    sums = sorted(by_part.mapInArrow(fold, "part int, n_docs long, n_tokens long, root binary").collect(), key=lambda r: r.part)
    return sums, merkle_root([bytes(r.root) for r in sums])


def _read_recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RECIPES).parquet(f"{path}-recipes")


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """Recipes and manifest pages (kind) with ``start``: ids of all documents before. A row per partition goes to the driver
    and is broadcast; its root is held against the one on top."""
    sums, root = _sums(spark, path)
    top = spark.read.schema(_TOP).parquet(f"{path}-top").collect()
    if len(top) != 1 or (bytes(top[0].root), top[0].n_docs, top[0].n_tokens) != (root, sum(r.n_docs for r in sums), sum(r.n_tokens for r in sums)):
        raise ValueError("the manifest doesn't match the root on top")
    before, at = [], 0
    for r in sums:
        before.append((r.part, at))
        at += r.n_tokens
    offsets = spark.createDataFrame(before, "part int, before long")
    recipes = _read_recipes(spark, path).join(F.broadcast(offsets), "part", "left")
    return recipes.select("kind", "part", "page", "doc_id", (F.coalesce("before", F.lit(0)) + F.col("start_in_part")).alias("start"), "n_docs", "n_tokens", "digests", "sizes", "root")


def read_chunks(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """What the stored bytes of each chunk give: digest, number of ids, crc32 of the ids as unsigned 32-bit integers.

    A payload that doesn't match its digest raises ValueError."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for b in batches:
            digests, counts, checks = b.column("digest").to_pylist(), [], []
            for digest, payload in zip(digests, b.column("payload"), strict=True):
                raw = payload.as_buffer()
                if hashlib.blake2b(raw, digest_size=DIGEST).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} doesn't match its digest")
                ids = np.frombuffer(raw, f"<u{width}")
                counts.append(len(ids))
                checks.append(zlib.crc32(ids.astype("<u4")))
            yield pa.record_batch([b.column("digest"), pa.array(counts, pa.int64()), pa.array(checks, pa.int64())], names=["digest", "n_ids", "crc"])

    stored = spark.read.schema(_STORED).parquet(path)
    return stored.where("kind = 'chunk'").select("digest", "payload").mapInArrow(run, "digest binary, n_ids long, crc long")


def _zero_operators() -> np.ndarray:
    """The linear maps on crc32 states that 4 * 2**k zero bytes make, as 32 columns each."""
    polynomial = 0xEDB88320
    one_bit = np.array([polynomial] + [1 << i for i in range(31)], np.uint64)

    def twice(m: np.ndarray) -> np.ndarray:
        return apply_map(m, m)

    m = one_bit
    for _ in range(5):  # 32 bits
        m = twice(m)
    out = [m]
    for _ in range(40):
        out.append(twice(out[-1]))
    return np.array(out)


def apply_map(m: np.ndarray, states: np.ndarray) -> np.ndarray:
    out = np.zeros_like(states)
    for bit in range(32):
        out ^= np.where((states >> np.uint64(bit)) & np.uint64(1), m[bit], np.uint64(0))
    return out


def combine_crcs(crcs: np.ndarray, counts: np.ndarray, owners: np.ndarray, n_owners: int) -> np.ndarray:
    """crc32 of each owner's ids from those of its chunks (in order): each chunk's state is moved over the ids that follow."""
    after = np.cumsum(counts[::-1])[::-1] - counts
    total = np.zeros(n_owners + 1, np.int64)
    np.add.at(total, owners, counts)
    later = np.concatenate([np.cumsum(total[:n_owners][::-1])[::-1], [0]])[1:]
    shift = (after - later[owners]).astype(np.uint64)
    states, maps = crcs.astype(np.uint64), _zero_operators()
    for k in range(int(shift.max()).bit_length() if len(shift) else 0):
        on = (shift >> np.uint64(k)) & np.uint64(1) == 1
        states[on] = apply_map(maps[k], states[on])
    out = np.zeros(n_owners, np.uint64)
    np.bitwise_xor.at(out, owners, states)
    return out.astype(np.int64)


def _check_pages(rows: pa.Table) -> pa.RecordBatch:
    """The documents of whole pages from rows sorted by (part, page, start, seq): first a page's row of the manifest (seq -1),
    then each document's chunks as they were found."""
    seq, start = rows["seq"].to_numpy(), rows["start"].to_numpy()
    if rows["n_ids"].null_count != int((seq < 0).sum()):
        raise ValueError("a chunk is missing")
    page_of = np.cumsum(seq < 0) - 1
    heads = np.flatnonzero(seq < 0)
    use = np.flatnonzero(seq >= 0)
    firsts = use[seq[use] == 0]
    if len(seq) and seq[0] >= 0 or len(use) != int(rows["n_chunks"].take(pa.array(firsts)).to_numpy().sum()) or len(firsts) != int(rows["n_docs"].take(pa.array(heads)).to_numpy().sum()):
        raise ValueError("a page's rows are not as many as the manifest says")
    owner = np.cumsum(seq[use] == 0) - 1
    counts, crcs = (rows[c].take(pa.array(use)).to_numpy() for c in ("n_ids", "crc"))
    n = len(firsts)
    tokens = np.bincount(owner, counts, n).astype(np.int64)
    first = rows.take(pa.array(firsts))
    if (tokens != first["n_tokens"].to_numpy()).any():
        raise ValueError("a document's ids are not as many as its recipe says")
    found = rows["digest"].take(pa.array(use)).to_pylist()
    edges = np.searchsorted(owner, np.arange(n + 1)).tolist()
    roots = [merkle_root(found[a:b]) for a, b in pairwise(edges)]
    if roots != first["root"].to_pylist():
        raise ValueError("a document's chunks don't give its Merkle root")
    edges = np.searchsorted(page_of[firsts], np.arange(len(heads) + 1)).tolist()
    if [merkle_root(roots[a:b]) for a, b in pairwise(edges)] != rows["root"].take(pa.array(heads)).to_pylist():
        raise ValueError("a page's documents don't give its root in the manifest")
    if np.bincount(page_of[firsts], tokens, len(heads)).astype(np.int64).tolist() != rows["n_tokens"].take(pa.array(heads)).to_pylist():
        raise ValueError("a page's ids are not as many as the manifest says")
    columns = [first["doc_id"], pa.array(start[firsts]), pa.array(tokens), pa.array(combine_crcs(crcs, counts, owner, n)), pa.array(np.bincount(owner, minlength=n)), pa.array([r.hex() for r in roots], pa.string())]
    return pa.record_batch([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32", "chunks", "merkle_root"])


def verify(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """Per document, from the stored bytes: doc_id, start, n_tokens, ids_crc32, chunks, merkle_root; all of the module's
    checks are made on the way. Chunks' payloads are read where they lie; only digests and checksums move, to the page of
    the document that uses them."""
    use = "part int, page long, start long, seq long, doc_id long, n_docs long, n_tokens long, n_chunks long, root binary"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            head = pc.equal(b.column("kind"), "manifest").to_numpy(zero_copy_only=False)
            joined = b.column("digests").to_pylist()
            n = np.array([1 if d is None else len(d) // DIGEST for d in joined], np.int64)
            rows = pa.array(np.repeat(np.arange(len(n)), n))
            flat = pa.array([x for d in joined for x in ([None] if d is None else _split(d))], pa.binary())
            seq = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            is_head = head[rows.to_numpy()] if len(rows) else np.zeros(0, bool)
            inner = pa.array(seq > 0)  # what a document's first row has already is null in the others
            own = [pc.if_else(inner, pa.scalar(None, b.schema.field(c).type), b.column(c).take(rows)) for c in ("doc_id", "n_docs", "n_tokens")]
            root = pc.if_else(inner, pa.scalar(None, pa.binary()), b.column("root").take(rows))
            yield pa.record_batch([b.column("part").take(rows), b.column("page").take(rows), b.column("start").take(rows), pa.array(np.where(is_head, -1, seq)), *own, pc.if_else(inner, pa.scalar(None, pa.int64()), pa.array(n).take(rows)), root, flat], names=[*(x.split()[0] for x in use.split(", ")), "digest"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        kept: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            heads = np.flatnonzero(b.column("seq").to_numpy() < 0)
            if len(heads) and (kept or heads[-1]):  # up to the last page that begins here all pages are whole
                kept.append(b.slice(0, heads[-1]))
                yield _check_pages(pa.Table.from_batches(kept).combine_chunks())
                kept, b = [], b.slice(heads[-1])
            kept.append(b)
        if kept:
            yield _check_pages(pa.Table.from_batches(kept).combine_chunks())

    recipes = read_recipes(spark, path)
    uses = recipes.select("kind", "part", "page", "doc_id", "start", "n_docs", "n_tokens", "digests", "root").mapInArrow(spread, f"{use}, digest binary")
    found = uses.join(read_chunks(spark, path, width), "digest", "left").repartition("part", "page").sortWithinPartitions("part", "page", "start", "seq")
    return found.mapInArrow(gather, "doc_id long, start long, n_tokens long, ids_crc32 long, chunks long, merkle_root string")


def reconstruct(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """doc_id, start, ids: the streams put together again from the stored chunks. A chunk that is missing or doesn't match its digest, and
    chunks that don't give a recipe's number of ids or its Merkle root, raise ValueError."""
    recipes = read_recipes(spark, path).where("kind = 'recipe'").select("doc_id", "start", "n_tokens", "digests", "root")
    names = ["doc_id", "start", "n_tokens", "root", "seq", "n_chunks", "digest"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens", "root", "digests")]
            rows = [(doc, start, n, root, i // DIGEST, len(d) // DIGEST, d[i : i + DIGEST]) for doc, start, n, root, d in zip(*columns, strict=True) for i in range(0, len(d), DIGEST)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = []
            for doc, n, root, chunks, parts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "root", "n_chunks", "parts")), strict=True):
                if len(parts) != chunks or [p["seq"] for p in parts] != list(range(chunks)):
                    raise ValueError(f"document {doc} has {len(parts)} of {chunks} chunks")
                for p in parts:
                    if p["payload"] is None:
                        raise ValueError(f"a chunk of document {doc} is missing")
                    if hashlib.blake2b(p["payload"], digest_size=DIGEST).digest() != p["digest"]:
                        raise ValueError(f"a chunk of document {doc} doesn't match its digest")
                if merkle_root([p["digest"] for p in parts]) != root:
                    raise ValueError(f"the chunks of document {doc} don't give its Merkle root")
                found = np.frombuffer(b"".join(p["payload"] for p in parts), f"<u{width}").astype(np.int64)
                if len(found) != n:
                    raise ValueError(f"document {doc} has {len(found)} of {n} ids")
                ids.append(found)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield pa.record_batch([b.column("doc_id"), b.column("start"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "start", "ids"])

    stored = spark.read.schema(_STORED).parquet(path).where("kind = 'chunk'").select("digest", "payload")
    uses = recipes.mapInArrow(spread, "doc_id long, start long, n_tokens long, root binary, seq long, n_chunks long, digest binary")
    found = uses.join(stored, "digest", "left")  # the uses of a chunk that many documents share can be split, as the join is an outer one
    parts = found.groupBy("doc_id", "start").agg(F.first("n_tokens").alias("n_tokens"), F.first("root").alias("root"), F.first("n_chunks").alias("n_chunks"), F.sort_array(F.collect_list(F.struct("seq", "digest", "payload"))).alias("parts"))
    return parts.mapInArrow(join, "doc_id long, start long, ids array<long>")


def store_and_verify(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to a new store in the shared folder, read it back and return ``verify``'s rows."""
    spark = docs.sparkSession
    path = workspace(spark, "store")
    write_store(docs, path, tokenizer_path, end_id)
    return verify(spark, path)
