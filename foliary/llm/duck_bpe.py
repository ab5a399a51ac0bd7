"""Byte-level BPE by relational algebra: an embedded DuckDB in each partition runs the merges as a recursive query.

Each distinct word (a match of the split pattern) is a set of rows (word, position, token). One step of the recursion
joins neighbouring tokens with the merge table, takes each word's pair of least rank, and contracts its places from the
left (only the leftmost one where the result could be part of a pair of still lower rank); words without a pair leave the
recursion. Decoding joins the ids of each document with the vocabulary and aggregates their bytes in position order.

Long words are encoded as overlapping blocks, which are joined at a token that both have at one place. That is exact: a sequence
of tokens is the encoding of its bytes if and only if each two neighbours are the encoding of theirs, as the first merge over
a boundary would also be made where only its two tokens stand; in the joined sequence every two neighbours come from one block.
Blocks that share no token in their overlap become one block and are encoded again.

Null texts are empty texts; an empty text has no ids. Ties of rank go to the leftmost pair. Words that are in the
vocabulary as a whole are one id. Repeated rows are encoded once each; extra columns are ignored; an empty table gives an
empty result. Words of any length go through the same recursion.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from foliary.llm.common import quiet_threads, slices, texts
from foliary.llm.pieces import PieceTable, flat_lists, worker_table

#: For blocks of any length: state is held by key, so that memory doesn't grow with the number of steps.
_ENCODE_LONG = """
WITH RECURSIVE state(word, pos, tok) USING KEY (word, pos) AS (
  SELECT word, pos, tok FROM start_rows
  UNION ALL
  SELECT word, pos, CASE WHEN coalesce(lag(here) OVER o, false) THEN -1 WHEN here THEN best >> 32 ELSE tok END AS tok
  FROM (
    SELECT word, pos, tok, best, least AND (nth - coalesce(max(CASE WHEN NOT least THEN nth END) OVER o, 0)) % 2 = 1 AS here
    FROM (
      SELECT word, pos, tok, nth, best, coalesce(pair = best, false) AS least
      FROM (
        SELECT a.*, m.pair + CASE WHEN m.alone THEN a.pos ELSE 0 END AS pair,
               min(m.pair + CASE WHEN m.alone THEN a.pos ELSE 0 END) OVER (PARTITION BY a.word) AS best
        FROM (
          SELECT word, pos, tok, lead(tok) OVER o AS nxt, row_number() OVER o AS nth
          FROM state WHERE tok >= 0 WINDOW o AS (PARTITION BY word ORDER BY pos)
        ) a LEFT JOIN merges m ON m.lft = a.tok AND m.rgt = a.nxt
      ) WHERE best IS NOT NULL
    ) WINDOW o AS (PARTITION BY word ORDER BY pos)
  ) WINDOW o AS (PARTITION BY word ORDER BY pos)
)
SELECT word, pos, tok FROM state WHERE tok >= 0 ORDER BY word, pos
"""
#: For short words, of which there are most, the leftmost least pair of each is contracted in a step; ``spot`` orders all rows,
#: word by word. Ended words' rows are marked done.
_ENCODE_SHORT = """
WITH RECURSIVE state(word, spot, tok, done) AS (
  SELECT word, spot, tok, false FROM start_rows
  UNION ALL
  SELECT word, spot, tok, done FROM (
    WITH pairs AS MATERIALIZED (
      SELECT n.word, n.spot, n.tok, p.pair + n.spot AS pair
      FROM (SELECT word, spot, tok, CASE WHEN lead(word) OVER o = word THEN lead(tok) OVER o END AS nxt FROM state WHERE NOT done WINDOW o AS (ORDER BY spot)) n
      LEFT JOIN merges p ON p.lft = n.tok AND p.rgt = n.nxt
    ), least AS (SELECT word, min(pair) AS best FROM pairs GROUP BY word)
    SELECT word, spot, CASE WHEN here THEN best >> 32 ELSE tok END AS tok, best IS NULL AS done, coalesce(lag(here) OVER (ORDER BY spot), false) AS swallowed
    FROM (SELECT a.word, a.spot, a.tok, b.best, coalesce(a.pair = b.best, false) AS here FROM pairs a JOIN least b ON a.word = b.word)
  ) WHERE NOT swallowed
)
SELECT word, spot, tok FROM state WHERE done ORDER BY spot
"""
_SHORT = 96  # bytes
_STEP, _OVERLAP = 64, 32  # of the blocks of longer words
_DECODE = "SELECT i.doc, string_agg(v.chars, '' ORDER BY i.pos) AS chars FROM id_rows i JOIN vocabulary v ON v.tok = i.tok GROUP BY i.doc ORDER BY i.doc"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class DuckBpe:
    """Encoder and decoder of words; one per Python worker."""

    def __init__(self, ranks_path: str, pattern: str, memory: str = "250MB") -> None:
        import duckdb

        self.ranks = read_ranks(ranks_path)
        self.find = regex.compile(pattern).findall
        pairs = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        lft, rgt, rank = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), (), ())))
        # A merge is alone if what it makes may take part in a pair of lower rank: then only its leftmost place is contracted
        # in a step. All places of any other merge are contracted at once, as nothing can come between them.
        lower = np.concatenate([part[rank < part] for part in (lft, rgt)])
        merge_rows = pa.table({"lft": lft, "rgt": rgt, "pair": rank << 32, "alone": np.isin(rank, lower)})  # noqa: F841  read below
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        # a character for each byte
        vocabulary_rows = pa.table({"tok": np.fromiter(self.ranks.values(), np.int64, len(self.ranks)), "chars": [b.decode("latin-1") for b in self.ranks]})  # noqa: F841
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")
        self.size_of = dict(zip(self.ranks.values(), map(len, self.ranks), strict=True))
        self.of_byte = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= _SHORT]
        for i, ids in zip(short, self._encode_many([words[i] for i in short]), strict=True):
            out[i] = ids
        long = [i for i, w in enumerate(words) if len(w) > _SHORT]
        for i, ids in zip(long, self._encode_long([words[i] for i in long]), strict=True):
            out[i] = ids
        return out

    def _encode_long(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        spans = {i: [(a, min(len(w), a + _STEP + _OVERLAP)) for a in range(0, len(w) - _OVERLAP, _STEP)] for i, w in enumerate(words)}
        found: dict[tuple, list[tuple[int, int]]] = {}  # by word and span: (start, token) of each token
        chains = False
        while spans:
            new = [(i, s) for i, own in spans.items() for s in own if (i, s) not in found]
            for (i, (a, b)), ids in zip(new, self._encode_many([words[i][a:b] for i, (a, b) in new]), strict=True):
                sizes = [self.size_of[tok] for tok in ids]
                found[i, (a, b)] = list(zip(accumulate(sizes, initial=a), ids, strict=False))
            again = {}
            for i, own in spans.items():
                joined, merged = self._join([(s, found[i, s]) for s in own], chains)
                if merged == own:
                    out[i] = [tok for _, tok in joined]
                else:
                    again[i] = merged
            spans, chains = again, True
        return out

    @staticmethod
    def _join(blocks: list, chains: bool) -> tuple[list, list]:
        """(tokens of the joined blocks, spans): spans are fewer if two neighbours share no token and must become one.
        chains: blocks of which each shares none with the next all become one."""
        (begin, joined), merged, apart = blocks[0], [], False
        joined = last = list(joined)
        for span, tokens in blocks[1:]:
            there = {x for x in last[begin[0] - span[1] :] if x[0] >= span[0]}
            common = next((k for k, x in enumerate(tokens) if x in there), None)
            last = tokens
            if common is None and (chains or not apart):
                begin, apart = (begin[0], span[1]), True
                continue
            if apart:
                joined = list(tokens)
            else:
                while joined[-1] != tokens[common]:
                    joined.pop()
                joined += tokens[common + 1 :]
            merged.append(begin)
            begin, apart = span, False
        merged.append(begin)
        return joined, merged

    def _encode_many(self, words: list[bytes]) -> list[list[int]]:
        """Words in groups of bounded work: a group's rows over all steps are about the sum of the squares of its lengths."""
        out: list[list[int]] = []
        start = 0
        while start < len(words):
            stop, work, long = start, 0, len(words[start]) > _SHORT
            while stop < len(words) and work < 4_000_000 and (len(words[stop]) > _SHORT) == long:
                work += len(words[stop]) ** 2
                stop += 1
            out += self._encode(words[start:stop], long)
            start = stop
        return out

    def _encode(self, words: list[bytes], long: bool) -> list[list[int]]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        total = int(sizes.sum())
        at = np.arange(total)
        start_rows = pa.table({  # noqa: F841
            "word": np.repeat(np.arange(len(words)), sizes),
            "pos" if long else "spot": at - np.repeat(np.cumsum(sizes) - sizes, sizes) if long else at,
            "tok": self.of_byte[np.frombuffer(b"".join(words), np.uint8)],
        })
        found = self.con.sql(_ENCODE_LONG if long else _ENCODE_SHORT).to_arrow_table()
        counts = np.bincount(found["word"].to_numpy(), minlength=len(words))
        flat, ends = found["tok"].to_numpy().tolist(), np.cumsum(counts).tolist()
        return [flat[e - n : e] for e, n in zip(ends, counts.tolist(), strict=True)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each document; ends: offsets of documents in ids, from 0."""
        sizes = np.diff(ends)
        id_rows = pa.table({"doc": np.repeat(np.arange(len(sizes)), sizes), "pos": np.arange(len(ids)), "tok": ids.astype(np.int64)})  # noqa: F841
        found = self.con.sql(_DECODE).to_arrow_table()
        out = [b""] * len(sizes)
        for doc, chars in zip(found["doc"].to_pylist(), found["chars"].to_pylist(), strict=True):
            out[doc] = chars.encode("latin-1")
        return out

    def table(self, limit: int = 200_000, block: int = 20_000) -> PieceTable:
        """A piece table whose pieces are split by the pattern and whose words DuckDB encodes, at most ``block`` at a time."""
        find, known = self.find, {}

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            nonlocal known
            split = [find(p) for p in pieces]
            if len(known) > limit:
                known = {}
            new = list({w: None for ws in split for w in ws if w not in known})
            for start in range(0, len(new), block):
                raw = [w.encode() for w in new[start : start + block]]
                ids: list = [[self.ranks[b]] if b in self.ranks else None for b in raw]
                rest = [i for i, x in enumerate(ids) if x is None]
                for i, x in zip(rest, self.encode_words([raw[i] for i in rest]), strict=True):
                    ids[i] = x
                known.update(zip(new[start : start + block], ids, strict=True))
            return flat_lists([[i for w in ws for i in known[w]] for ws in split])

        return PieceTable(encode, limit)


def _table_of(duck: DuckBpe) -> PieceTable:
    table = duck.table()
    table.duck = duck
    return table


SCHEMA = "doc_id long, ids array<int>, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False, slice_bytes: int = 4_000_000) -> DataFrame:
    """Ids of each whole text and the bytes they decode to, or (``digests``) their number and SHA-256 hashes.

    ids are hashed as little-endian unsigned 32-bit integers. No shuffle: each partition is encoded where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads(keep_tables=True)
        pieces = worker_table(("duck", ranks_path, pattern), lambda: _table_of(DuckBpe(ranks_path, pattern)))
        for batch in batches:
            for start, stop in slices(batch.column("text"), slice_bytes):
                part = batch.slice(start, stop - start)
                ids, ends = pieces.encode_texts(part.column("text"))
                raw = pieces.duck.decode(ids, ends)
                if not digests:
                    yield pa.record_batch([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array(raw, pa.binary())], names=["doc_id", "ids", "decoded"])
                    continue
                ids = ids.astype("<u4", copy=False)
                of_ids = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in pairwise(ends.tolist())]
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(ends)), pa.array(of_ids, pa.string()), pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, DIGESTS if digests else SCHEMA)
