"""Savitzky-Golay smoothing of planned actions, as window expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@lru_cache(maxsize=32)
def hat(window: int, order: int) -> np.ndarray:
    """The matrix that maps ``window`` points to their least-squares polynomial's values."""
    x = np.vander(np.arange(window) - window // 2, order + 1)
    return x @ np.linalg.pinv(x)


def effective_window(n: int, window: int, order: int) -> int:
    """The window that a sequence of n points gets; 0 leaves it alone."""
    if n < 3:
        return 0
    w = min(window, n)
    w -= w % 2 == 0
    if w <= order:
        w = order + 1 + order % 2
    if w > n:
        w = n - (n % 2 == 0)
    return 0 if w <= order or w < 3 else w


def _times(c: float) -> Callable[[Column], Column]:
    return lambda x: x * F.lit(c)


def _plus(c: float) -> Callable[[Column, Column], Column]:
    return lambda total, x: total + x * F.lit(c)


def smooth(rows: DataFrame, window: int = 7, order: int = 2, exclude: Sequence[int] = (), dims: int = 14, keys: Sequence[str] = ("segment", "list_pos", "episode_index"), place: str = "out_idx", length: str = "usable_len", vector: str = "action") -> DataFrame:
    """Smooth a vector along each sequence; ends follow the polynomial of the first or last window.

    A row's neighbours come by lag and lead, which Spark streams and spills, so a sequence need not fit in
    memory.  Null anywhere in a sequence leaves it unchanged, as do fewer than three points.
    """
    if window < 3 or order < 1:
        raise ValueError("the window is at least 3 and the order at least 1")
    ordered = Window.partitionBy(*keys).orderBy(place)
    whole = Window.partitionBy(*keys)
    reach = range(-(window - 1), window)
    near = {j: (F.col(vector) if j == 0 else F.lead(vector, j).over(ordered) if j > 0 else F.lag(vector, -j).over(ordered)) for j in reach}
    rows = rows.withColumn("_near", F.struct(*[v.alias(f"p{j + window}") for j, v in near.items()])).withColumn("_null", F.max(F.col(vector).isNull().cast("int")).over(whole))
    n, k = F.col(length), F.col(place)

    def fitted(w: int, row: int, start: int) -> Column:
        """Values of row ``row`` of the hat matrix, whose points start ``start`` places away."""
        total = None
        for j, c in enumerate(hat(w, order)[row].tolist()):
            point = F.col("_near").getField(f"p{start + j + window}")
            total = F.transform(point, _times(c)) if total is None else F.zip_with(total, point, _plus(c))
        return total

    def by_window(w: int) -> Column:
        half = w // 2
        out = None
        for r in range(half):
            ends = [(k == r, fitted(w, r, -r)), (k == n - 1 - r, fitted(w, w - 1 - r, -(w - 1 - r)))]
            for when, value in ends:
                out = F.when(when, value) if out is None else out.when(when, value)
        return out.otherwise(fitted(w, half, -half))

    # windows by length: short sequences get smaller ones
    cases: dict[int, list[int]] = {}
    for m in range(0, window + 1):
        cases.setdefault(effective_window(m, window, order), []).append(m)
    result = F.col(vector)
    for w, lengths in cases.items():
        if w:
            at = (n >= min(lengths)) if max(lengths) == window else n.isin(lengths)
            result = F.when(at, by_window(w)).otherwise(result)
    kept = F.array(*[F.lit(d in set(exclude)) for d in range(dims)])
    masked = F.zip_with(F.zip_with(F.col(vector), result, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), kept, lambda p, k: F.when(k, p["x"]).otherwise(p["y"]))
    return rows.withColumn(vector, F.when(F.col("_null") == 1, F.col(vector)).otherwise(masked)).drop("_near", "_null")
