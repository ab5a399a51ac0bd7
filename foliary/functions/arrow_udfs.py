"""Functions that built-in expressions can't state: sequence similarity, canonical JSON.

All are Arrow-batched; put them behind filters and joins, as the optimiser doesn't move them."""

from __future__ import annotations

import difflib
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def _plain(text: str) -> str:
    return " ".join(re.sub(r"[#*_>`|]", " ", text).split())


#: Above so many pairs of characters the table of runs would take too much memory; difflib gives the same ratio then.
_MOST_PAIRS = 1 << 24


def sequence_ratio(a: str, b: str, autojunk: bool = True) -> float:
    """``SequenceMatcher(None, a, b, autojunk).ratio()``: lengths of the common runs that end at each pair of places are found once, and
    the longest run of each part (of equal ones the first in a, then in b) is looked up among them."""
    n, m = len(a), len(b)
    if a == b or not n or not m:
        return 1.0 if a == b else 0.0
    if n * m > _MOST_PAIRS:
        return difflib.SequenceMatcher(None, a, b, autojunk).ratio()
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in (a, b))
    popular = np.zeros(m, bool)
    if autojunk and m >= 200:
        _, inverse, counts = np.unique(y, return_inverse=True, return_counts=True)
        popular = (counts > m // 100 + 1)[inverse]
    whole = np.int16 if max(n, m) < 1 << 15 else np.int32
    runs = np.zeros((n + 1, m + 1), whole)
    characters, rows = np.unique(x, return_inverse=True)
    equal = ((characters[:, None] == y) & ~popular).astype(whole)
    for i, row in enumerate(rows.tolist()):
        own = runs[i + 1, 1:]
        np.add(runs[i, :-1], 1, out=own)
        np.multiply(own, equal[row], out=own)
    runs = runs[1:, 1:]
    total, todo, ups = 0, [(0, n, 0, m)], np.arange(1, max(n, m) + 1, dtype=whole)
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        part = np.minimum(runs[alo:ahi, blo:bhi], ups[: bhi - blo])
        np.minimum(part, ups[: ahi - alo, None], out=part)
        i, j = divmod(int(part.argmax()), bhi - blo)
        k = int(part[i, j])
        i, j = (alo + i - k + 1, blo + j - k + 1) if k else (alo, blo)
        while i > alo and j > blo and a[i - 1] == b[j - 1]:  # popular characters only lengthen a run
            i, j, k = i - 1, j - 1, k + 1
        while i + k < ahi and j + k < bhi and a[i + k] == b[j + k]:
            k += 1
        if k:
            total += k
            if alo < i and blo < j:
                todo.append((alo, i, blo, j))
            if i + k < ahi and j + k < bhi:
                todo.append((i + k, ahi, j + k, bhi))
    return 2.0 * total / (n + m)


@F.pandas_udf(DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratio of matching blocks of the texts without markup signs, to 4 places; 0 if one is blank."""
    return pd.Series([round(sequence_ratio(_plain(a), _plain(b)), 4) if a and b and a.strip() and b.strip() else 0.0 for a, b in zip(left, right, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def word_sequence_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratio over lower-case texts with single spaces, without the heuristic for frequent characters."""
    normal = lambda t: " ".join((t or "").casefold().split())
    return pd.Series([sequence_ratio(normal(a), normal(b), autojunk=False) for a, b in zip(left, right, strict=True)], dtype="float64")


@F.pandas_udf(StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """JSON text with sorted keys and characters as they are."""
    return values.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True))


def exact_round(places: int):
    """Rounding of the exact binary value, ties to even, as Python does: built-in rounding starts from the shortest decimal."""

    @F.pandas_udf(DoubleType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None or x != x else round(x, places))

    return run
