"""Words of whole texts as codes of a dictionary, and counts over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Signs that are cut off both ends of a word.
SIGNS = ".,;:!?\"'()[]{}<>|%*$#&@~^_=+/\\-–—…«»„“”‚‘’¡¿`"
#: White space beyond space, line feed and tab; scripts written without spaces.
_OTHER_SPACE = r"[\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"


def _spaced(texts: pa.Array) -> pa.Array:
    """Each white space character as a space; characters of scripts without spaces as words of their own."""
    out = pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " ")
    odd = pc.match_substring_regex(texts, f"{_OTHER_SPACE}|{_UNSPACED}")
    if pc.any(odd).as_py():
        some = pc.replace_substring_regex(out.filter(odd), _OTHER_SPACE, " ")
        out = pc.replace_with_mask(out, odd, pc.replace_substring_regex(some, _UNSPACED, r" \0 "))
    return out


class Words:
    """Lower-case words between white space of an array of texts (null: empty): ``dictionary`` with signs cut off, ``raw``
    as written, ``codes`` per word, ``doc`` per word and ``counts`` per text. White space is Unicode's; each character of a
    script without spaces is a word."""

    def __init__(self, array: pa.Array) -> None:
        array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
        self.texts = pc.fill_null(array, "")
        split = pc.split_pattern(pc.utf8_lower(_spaced(self.texts)), " ")
        flat = split.flatten().dictionary_encode()
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        self.raw = flat.dictionary
        self.dictionary = pc.utf8_trim(self.raw, SIGNS)
        codes = flat.indices.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(array)), np.diff(offsets))
        empty = pc.equal(self.raw, "").to_numpy(zero_copy_only=False)
        full = ~empty[codes] if len(codes) else np.zeros(0, bool)
        self.codes, self.doc, self.n = codes[full].astype(np.int64), doc[full], len(array)
        self.counts = np.bincount(self.doc, minlength=self.n)

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sum over each text's words of a value per dictionary entry."""
        return np.bincount(self.doc, values[self.codes], self.n)

    def hits(self, matches: list, n_kinds: int) -> np.ndarray:
        """Texts x kinds: how many words match a kind; matches: kinds of each dictionary entry (empty for most)."""
        out = np.zeros((self.n, n_kinds), np.float64)
        some = np.fromiter((bool(m) for m in matches), bool, len(matches))
        at = np.flatnonzero(some[self.codes]) if len(self.codes) else np.zeros(0, np.int64)
        for doc, code in zip(self.doc[at].tolist(), self.codes[at].tolist(), strict=True):
            for kind in matches[code]:
                out[doc, kind] += 1
        return out


_CLASS = np.zeros(256, np.int64)
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = 1 if _i >= 0xC0 or _c.isascii() and _c.isalpha() else 2 if _c.isascii() and _c.isdigit() else 3 if _c in " \t\r\n" else 4 if _c in ".,;:!?'\"()-" else 0 if 0x80 <= _i < 0xC0 else 5
STYLE = ["words", "distinct", "same_as_last", "again_soon", "upper", "digits", "signs", "odd_signs", "pipes", "bangs", "word_length", "lines", "long_words", "odd_word_share"]


def style(array: pa.Array) -> np.ndarray:
    """Texts x len(STYLE): how a text is written, whatever its language; shares lie in 0 to 1."""
    w = Words(array)
    n, words = w.n, np.maximum(w.counts, 1)
    key = np.unique(w.doc * max(1, len(w.raw)) + w.codes)
    distinct = np.bincount(key // max(1, len(w.raw)), minlength=n)
    repeats = lambda k: np.bincount(w.doc[k:], (w.doc[k:] == w.doc[:-k]) & (w.codes[k:] == w.codes[:-k]), n) if len(w.codes) > k else np.zeros(n)
    raw = w.texts.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]] if n and raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    counts = np.array([_sums(_CLASS[data] == c, ends) for c in range(1, 6)])
    letters = np.maximum(counts[0], 1)
    lower = pc.utf8_lower(w.texts).cast(pa.large_binary())
    low_ends = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + n + 1]
    if n and len(data) == low_ends[-1] - low_ends[0] and np.array_equal(low_ends - low_ends[0], ends):
        low = np.frombuffer(lower.buffers()[2], np.uint8)[low_ends[0] : low_ends[-1]] if len(data) else data
        upper = _sums(data != low, ends)
    else:
        upper = np.array([sum(c.isupper() for c in t.as_py()) for t in w.texts], np.float64)
    chars = np.maximum(np.diff(ends), 1)
    length = pc.utf8_length(w.raw).to_numpy(zero_copy_only=False).astype(np.float64)
    trimmed = pc.utf8_length(w.dictionary).to_numpy(zero_copy_only=False)
    # signs at a word's end beyond one comma, stop or the like
    odd = (length - trimmed >= 2) | (trimmed == 0)
    return np.column_stack([
        np.log1p(w.counts), distinct / words, repeats(1) / words, np.maximum.reduce([repeats(k) for k in range(2, 13)] + [np.zeros(n)]) / words,
        upper / letters, counts[1] / chars, counts[3] / words, counts[4] / words,
        _sums(data == ord("|"), ends) / words, _sums(data == ord("!"), ends) / words,
        w.per_doc(length) / words / 10 if len(length) else np.zeros(n), _sums(data == 10, ends) / words,
        w.per_doc((length > 14).astype(float)) / words if len(length) else np.zeros(n), w.per_doc(odd.astype(float)) / words if len(length) else np.zeros(n),
    ])


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int32)  # texts come in slices of a few MB
    np.cumsum(flags, out=total[1:])
    return (total[ends[1:]] - total[ends[:-1]]).astype(np.float64)
