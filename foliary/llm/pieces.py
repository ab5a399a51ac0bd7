"""Whole texts to token ids through a table of distinct pieces.

A tokenizer's pre-tokens never span the boundary between a character that is no white space and white space that
follows it, nor that between a letter or digit and a comma or full stop. Texts are cut at such places, each distinct
piece is encoded once by the tokenizer's own library, and the ids of a text are gathered from its pieces' ids. The second
kind of cut is made only after letters and digits that no normalisation of a tokenizer takes apart (those of Latin scripts
without U+0130); texts with other characters there, or with runs of white space, are cut by a slower rule. Texts that hold
the marker character or the string of a special token are encoded whole. So results equal encoding each text alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from foliary.llm.common import Growing, ragged_positions

MARK = "\x01"
_RUNS = re.compile(r"\s*\S+|\s+")
_SPACE_BEFORE_CUT = r"[\s\p{Z}\x0b\x{85}\x1c-\x1f][ \n]"
_SIGN_BEFORE_CUT = r"[^0-9A-Za-zÀ-ÖØ-öø-įıĲ-ňŊ-ɏ][,.][ \n]"


def marked(array: pa.Array, spaces_vanish: bool, special: str = "") -> tuple[pa.Array, list[int]]:
    """Texts with MARK at each cut, and the rows that must be encoded whole.

    spaces_vanish: the tokenizer drops white space, so that a cut inside a run of it does no harm. special: a pattern of
    strings that no cut may touch."""
    array = pc.fill_null(array, "")
    whole = np.flatnonzero(pc.match_substring_regex(array, MARK + special).to_numpy(zero_copy_only=False))
    if len(whole):
        blank = np.zeros(len(array), bool)
        blank[whole] = True
        array = pc.if_else(pa.array(blank), pa.scalar("", array.type), array)
    by_space = lambda a: pc.replace_substring(pc.replace_substring(a, " ", MARK + " "), "\n", MARK + "\n")
    plain = by_space(array)
    odd = pc.match_substring_regex(array, _SIGN_BEFORE_CUT)
    cut = pc.replace_substring(plain, "," + MARK, MARK + "," + MARK)
    cut = pc.replace_substring(cut, "." + MARK, MARK + "." + MARK)
    out = pc.if_else(odd, plain, cut)
    if not spaces_vanish:
        rows = np.flatnonzero(pc.match_substring_regex(array, _SPACE_BEFORE_CUT).to_numpy(zero_copy_only=False))
        if len(rows):
            flags = np.zeros(len(array), bool)
            flags[rows] = True
            slow = pa.array([MARK.join(_RUNS.findall(t.as_py())) for t in array.take(pa.array(rows))], array.type)
            out = pc.replace_with_mask(out, pa.array(flags), slow)
    return out, whole.tolist()


_LONGEST = 64
_RANDOM = np.random.default_rng(20)
_OF_BYTE = _RANDOM.integers(0, 1 << 64, (2, 256), np.uint64)
_OF_PLACE = _RANDOM.integers(0, 1 << 63, (2, _LONGEST), np.uint64) * np.uint64(2) + np.uint64(1)


def piece_keys(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit key, second 64-bit key, bytes) of each string; keys tell strings of up to 64 bytes apart."""
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8)[ends[0] : ends[-1]] if array.buffers()[2] is not None else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    starts = (ends[:-1] - ends[0])[sizes > 0]
    place = np.minimum(np.arange(len(data), dtype=np.int32) - np.repeat((ends[:-1] - ends[0]), sizes), _LONGEST - 1)
    keys = []
    with np.errstate(over="ignore"):
        for of_byte, of_place in zip(_OF_BYTE, _OF_PLACE, strict=True):
            x = sizes.astype(np.uint64)
            if len(starts):
                x[sizes > 0] += np.add.reduceat(of_byte[data] * of_place[place], starts)
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            keys.append(x ^ (x >> np.uint64(29)))
    return keys[0], keys[1], sizes


class PieceTable:
    """Ids of distinct pieces, known by 128-bit keys in sorted arrays.

    ``encode``: list of pieces -> (their ids in any order, where in them each piece's begin, number of ids of each).
    ``special``: pattern of strings whose texts are encoded whole. The table is bounded: when it holds 2 * ``limit`` pieces, the
    ``limit`` that the most batches used stay (counts of uses are halved then), the others are forgotten. Pieces of more than
    64 bytes are not kept."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], limit: int = 200_000, special: list[str] = ()) -> None:
        self.encode, self.limit = encode, limit
        self.special = "".join("|" + re.escape(s) for s in special)
        self.keys, self.second, self.which = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._clear()

    def _clear(self) -> None:
        self.ids, self.starts, self.lengths, self.uses = Growing(np.uint32), Growing(np.int32), Growing(np.int32), Growing(np.int32)

    def _forget(self) -> None:
        ids, starts, lengths, uses = self.ids.view(), self.starts.view(), self.lengths.view(), self.uses.view()
        keep = np.arange(len(self.which))
        if len(keep) > self.limit:
            keep = np.sort(np.argpartition(-uses[self.which], self.limit)[: self.limit])
        old = self.which[keep]
        self._clear()
        self.keys, self.second, self.which = self.keys[keep], self.second[keep], np.arange(len(keep), dtype=np.int32)
        n = lengths[old].astype(np.int64)
        self.ids.extend(ids[ragged_positions(starts[old].astype(np.int64), n)])
        self.starts.extend(np.cumsum(n) - n)
        self.lengths.extend(n)
        self.uses.extend(np.maximum(uses[old] // 2, 1))

    def index(self, pieces: pa.Array) -> np.ndarray:
        """Where each of some distinct pieces stands in the arrays; unknown ones are encoded."""
        key, second, sizes = piece_keys(pieces)
        out = np.full(len(key), -1, np.int64)
        order = np.argsort(key)
        at = np.empty(len(key), np.int64)
        at[order] = np.searchsorted(self.keys, key[order])
        taken = np.zeros(len(key), bool)
        if len(self.keys):
            here = np.minimum(at, len(self.keys) - 1)
            taken = self.keys[here] == key
            known = taken & (self.second[here] == second) & (sizes <= _LONGEST)
            out[known] = self.which[here[known]]
            self.uses.view()[out[known]] += 1
        new = np.flatnonzero(out < 0)
        if len(new):
            ids, starts, lengths = self.encode(pieces.take(pa.array(new)).to_pylist())
            base = self.starts.size
            out[new] = np.arange(base, base + len(new))
            self.starts.extend(self.ids.size + starts)
            self.lengths.extend(lengths)
            self.ids.extend(ids)
            self.uses.extend(np.ones(len(new), np.int32))
            keep = new[~taken[new] & (sizes[new] <= _LONGEST)]
            _, first = np.unique(key[keep], return_index=True)
            keep = keep[first]
            self.keys, self.second, self.which = (np.insert(a, at[keep], b[keep]) for a, b in ((self.keys, key), (self.second, second), (self.which, out.astype(np.int32))))
        return out

    def encode_texts(self, array: pa.Array, spaces_vanish: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the texts in ids)."""
        array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
        cut, whole = marked(array, spaces_vanish, self.special)
        split = pc.split_pattern(cut, MARK)
        del cut
        offsets = split.offsets.to_numpy().astype(np.int64)
        codes = split.flatten().dictionary_encode()
        del split
        index = self.index(codes.dictionary)[codes.indices.to_numpy(zero_copy_only=False)]
        offsets -= offsets[0]
        n = self.lengths.view()[index].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])
        out = self.ids.view()[ragged_positions(self.starts.view()[index].astype(np.int64), n)], ends[offsets]
        if whole:
            out = self._splice(*out, array, whole)
        if self.starts.size > 2 * self.limit:
            self._forget()
        return out

    def _splice(self, flat, offsets, array, whole):
        ids, starts, lengths = self.encode([array[i].as_py() for i in whole])
        pieces = [flat[offsets[i] : offsets[i + 1]] for i in range(len(offsets) - 1)]
        for i, start, n in zip(whole, starts.tolist(), lengths.tolist(), strict=True):
            pieces[i] = ids[start : start + n]
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)


def flat_lists(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array(list(map(len, found)), np.int64)
    return np.array(list(chain.from_iterable(found)), np.uint32), np.cumsum(lengths) - lengths, lengths


def library_table(tokenizer_path: str, limit: int = 200_000, lines: int = 128) -> PieceTable:
    """Pieces encoded by the tokenizers library with its own settings: strings of special tokens in a text become their ids.

    Plain pieces, those of printable characters without white space but a space at the start, are encoded ``lines`` at a time
    with a separator between them, a pre-token of one id that no plain piece holds: calls of the library for each piece cost
    several times as much."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    one = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    between = next((s for s in ("\n", " \x02 ") if len(one(s)) == 1 and one("a" + s + " b") == one("a") + one(s) + one(" b")), None)
    mark = one(between)[0] if between else None

    def each(pieces: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(pieces), lines) for e in tokenizer.encode_batch_fast(pieces[i : i + lines], add_special_tokens=False)]

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        plain = np.array([p.isprintable() and p.rfind(" ") <= 0 and p not in ("", " ") for p in pieces], bool)
        if not between or plain.sum() < 2:
            return flat_lists(each(pieces))
        own = pieces if plain.all() else [pieces[i] for i in np.flatnonzero(plain).tolist()]
        flat: list[int] = []
        for found in each([between.join(own[i : i + lines]) for i in range(0, len(own), lines)]):
            flat += found
            flat.append(mark)
        ids = np.array(flat, np.uint32)
        ends = np.flatnonzero(ids == mark)
        if len(ends) != len(own):  # the separator was not kept apart: one by one
            return flat_lists(each(pieces))
        rest = flat_lists(each([pieces[i] for i in np.flatnonzero(~plain).tolist()]))
        starts, lengths = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        starts[plain] = np.concatenate([[0], ends[:-1] + 1])
        lengths[plain] = ends - starts[plain]
        starts[~plain], lengths[~plain] = len(ids) + rest[1], rest[2]
        return np.concatenate([ids, rest[0]]), starts, lengths

    return PieceTable(encode, limit, special)


_TABLES: dict = {}  # common.quiet_threads empties it for operators that need none


def worker_table(key, make: Callable[[], PieceTable]) -> PieceTable:
    """One table per Python worker and key, kept from task to task."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]
