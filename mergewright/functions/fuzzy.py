"""String similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import by_value

by_value(__name__)

#: Pairs compared at once, for numpy temporaries of a few MB.
AT_ONCE = 4096


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of character codes for each text, short ones filled up with 0, and the lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(size.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return (out.astype(np.uint8) if out.max(initial=0) < 256 else out), size


def _compare(left: list[str], right: list[str]) -> np.ndarray:
    (a, n), (b, m) = codes(left), codes(right)
    if not a.shape[1] or not b.shape[1]:
        return np.zeros(len(left))
    rows = np.arange(len(left))
    column = np.arange(b.shape[1])
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    free = column < m[:, None]
    hit = np.zeros(a.shape, bool)
    far = int(reach.max())
    for i in range(a.shape[1]):
        # Each character of a takes the first free equal one of b within reach.
        low, high = max(0, i - far), min(b.shape[1], i + far + 1)
        if low >= high:
            break
        near = free[:, low:high] & (b[:, low:high] == a[:, i : i + 1]) & (np.abs(column[low:high] - i) <= reach[:, None]) & (i < n)[:, None]
        first = near.argmax(1)
        some = near[rows, first]
        hit[:, i] = some
        free[rows[some], low + first[some]] = False
    taken = (column < m[:, None]) & ~free
    k = hit.sum(1)
    turned = np.bincount(np.nonzero(hit)[0][a[hit] != b[taken]], minlength=len(left)) // 2
    some = np.maximum(k, 1)
    ratio = np.where(k > 0, (k / np.maximum(n, 1) + k / np.maximum(m, 1) + (k - turned) / some) / 3, 0.0)
    width = min(4, a.shape[1], b.shape[1])
    same = (a[:, :width] == b[:, :width]) & (np.arange(width) < np.minimum(n, m)[:, None])
    prefix = np.logical_and.accumulate(same, 1).sum(1)
    return np.where(ratio > 0.7, ratio + prefix * 0.1 * (1 - ratio), ratio)


def jaro_winkler_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """0 to 1 for each pair; a common prefix of up to 4 characters counts a tenth each from a Jaro ratio of over 0.7 on."""
    out = np.zeros(len(left))
    # Pairs of like lengths side by side, so that rows have little fill.
    order = np.lexsort((np.fromiter(map(len, right), np.int64, len(right)), np.fromiter(map(len, left), np.int64, len(left))))
    for at in range(0, len(order), AT_ONCE):
        some = order[at : at + AT_ONCE]
        out[some] = _compare([left[i] for i in some], [right[i] for i in some])
    return out


def jaro_winkler_ratio(a: str, b: str) -> float:
    return float(jaro_winkler_ratios([a], [b])[0])


def distinct_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """As jaro_winkler_ratios(), each distinct pair once."""
    place, known = pd.factorize(pd.MultiIndex.from_arrays([left, right])) if left else (np.zeros(0, np.int64), [])
    return jaro_winkler_ratios([x for x, _ in known], [y for _, y in known])[place] if left else np.zeros(0)


@F.pandas_udf(T.DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    whole = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[whole] = distinct_ratios(a[whole].tolist(), b[whole].tolist())
    return pd.Series(out).where(whole, None)


@F.pandas_udf(T.DoubleType())
def _best_of_names(left: pd.Series, right: pd.Series) -> pd.Series:
    combos = [[(x, y) for x in p for y in q if x is not None and y is not None] if p is not None and q is not None else [] for p, q in zip(left, right, strict=True)]
    size = np.fromiter(map(len, combos), np.int64, len(combos))
    a, b = [x for c in combos for x, _ in c], [y for c in combos for _, y in c]
    both = np.minimum(distinct_ratios(a, b), distinct_ratios([x[::-1] for x in a], [y[::-1] for y in b]))
    out = np.full(len(size), np.nan)
    some = size > 0
    if some.any():
        out[some] = np.maximum.reduceat(both, (np.cumsum(size) - size)[some])
    return pd.Series(out).where(some, None)


def percent(c: Column) -> Column:
    return F.round(c * 100, 2).cast("decimal(5,2)")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Similarity in percent with two decimals; null if a side is null."""
    return percent(_jaro_winkler(a, b))


def best_of_names(left: Column, right: Column) -> Column:
    """The best of all names of one array against all of the other, each the lesser of forward and reversed similarity, in
    percent with two decimals; null where an array is null or has no names."""
    return percent(_best_of_names(left, right))


def word_set(c: Column) -> Column:
    return F.array_distinct(F.split(c, " "))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; null if both are empty or one is null."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))
