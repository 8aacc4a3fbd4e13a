"""Jaro string distance (C12) — the one computation Spark lacks.

Spark 4.1 ships ``levenshtein`` and ``soundex`` only, so the distance is a
NumPy kernel over Arrow batches: the pairs of a batch are grouped by length
and compared together, one character place at a time.  Callers lower-case
both sides in Spark first (case-insensitive matching) and call it on
*distinct* pairs only.

Rules: match window ``max(max(la, lb) // 2 - 1, 0)``; half the number of
transposed matches, rounded down; similarity 0 when either text is empty
or nothing matches, 1 when both are equal; distance = 1 - similarity; NULL in
gives NULL out.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.session import ship_package

_BUCKET = 8           # texts whose lengths share a multiple of this are compared together
_CELLS = 1 << 21      # pairs × characters compared at once


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Code points, one row per text, zeros behind its end."""
    data = "".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, "<u4").reshape(len(texts), width)


def _similarities(a: list[str], b: list[str]) -> np.ndarray:
    """Similarity of pairs of non-empty, different texts of similar lengths."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    wide_a, wide_b = int(la.max()), int(lb.max())
    left, right = _codes(a, wide_a), _codes(b, wide_b)
    rows = np.arange(len(a))
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    place = np.arange(wide_b)[None, :]
    free = place < lb[:, None]
    hit_a = np.zeros((len(a), wide_a), bool)
    for i in range(wide_a):
        near = free & (right == left[:, i:i + 1]) & (abs(place - i) <= window) & (i < la)[:, None]
        first = near.argmax(axis=1)
        found = near[rows, first]
        hit_a[:, i] = found
        free[rows[found], first[found]] = False
    hit_b = ~free & (place < lb[:, None])
    # the matched characters of each side in order, moved to the front
    in_a = np.take_along_axis(left, np.argsort(~hit_a, axis=1, kind="stable"), 1)
    in_b = np.take_along_axis(right, np.argsort(~hit_b, axis=1, kind="stable"), 1)
    m = hit_a.sum(axis=1)
    width = int(m.max())
    moved = ((in_a[:, :width] != in_b[:, :width]) & (np.arange(width)[None, :] < m[:, None])).sum(axis=1) // 2
    some = np.maximum(m, 1)
    return np.where(m > 0, (m / la + m / lb + (m - moved) / some) / 3.0, 0.0)


def jaro_similarities(a: list[str], b: list[str]) -> np.ndarray:
    """Similarity of each pair ``a[i]``, ``b[i]``."""
    out = np.zeros(len(a))
    buckets: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, (x, y) in enumerate(zip(a, b)):
        if x and x == y:
            out[i] = 1.0
        elif x and y:
            buckets[len(x) // _BUCKET, len(y) // _BUCKET].append(i)
    for (_, wide), places in buckets.items():
        step = max(1, _CELLS // ((wide + 1) * _BUCKET))
        for start in range(0, len(places), step):
            part = places[start:start + step]
            out[part] = _similarities([a[i] for i in part], [b[i] for i in part])
    return out


@F.pandas_udf(T.DoubleType())
def _jaro_distance_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    missing = (a.isna() | b.isna()).to_numpy()
    out = 1.0 - jaro_similarities(a.fillna("").tolist(), b.fillna("").tolist())
    return pd.Series(out).mask(pd.Series(missing))


def jaro_distance(a: Column | str, b: Column | str) -> Column:
    """Jaro distance of two text columns (already case-folded by the caller)."""
    ship_package(SparkSession.getActiveSession())
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _jaro_distance_udf(a, b)
