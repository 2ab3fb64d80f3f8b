"""Whitening of embeddings by Chebyshev-filtered subspace iteration (operator 12).

Entries become integers, ``floor(1024 * c) + 100000``, so sums and deviations are
exact.  With the covariance V of these vectors, a block of ``components`` and
``GUARD`` further columns goes through rounds of

1. a Chebyshev polynomial of V, by its three-term recurrence, scaled so that it
   stays small on the unwanted part of the spectrum (from 0 to the block's least
   Ritz value) and grows above; each step is one pass over the vectors, in which a
   task centres its rows, multiplies them by the block and adds up one matrix of
   dimensions x columns;
2. QR, then Rayleigh-Ritz with one more pass.

Rounds end when every wanted pair is certified: the residual of V q = e q is below
``TOLERANCE`` of the largest eigenvalue, or at the rounding floor of its own size,
below ``LOOSEST``.  The last columns of the guard are drawn anew in every round, so
no direction can stay out of the block.  If ``ROUNDS`` pass, an error is raised.
The driver and each task hold matrices of dimensions x columns and nothing that
grows with the number of rows.

Rows whose vector is null, empty, or holds a null, non-finite or an entry of 2**40
or more are dropped, and so are vectors of another length than the most frequent
one (of several, the longest).  Rows with a null id or a repeated id are rows like
others.  Fewer dimensions than components give as many components as dimensions.
A component without variance (at most ``FLAT`` of the largest) has a null in
``whitened`` and isn't part of ``identity_error``.  Where a deviation doesn't fit in
64 bits it is null.  An empty table gives an empty table.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

COMPONENTS = 8
GUARD = 24
FRESH = 2
DEGREE = 12
ROUNDS = 60
TOLERANCE = 1e-14
LOOSEST = 1e-11
FLAT = 1e-13
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)


def finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


@dataclass(frozen=True)
class Model:
    """What whitening needs: the number of fitted rows, the sums of their entries, and the components as columns."""

    n: int
    sums: list[int]
    whole: np.ndarray  # the sums as integers of 64 bits, or as doubles where products with n don't fit in them
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    exact: bool  # whether deviations surely fit in 64 bits

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(e), not a number where a component has no variance."""
        alive = self.values > FLAT * max(self.values.max(initial=0), 0)
        return np.where(alive, 1 / np.sqrt(np.where(alive, self.values, 1)), np.nan)


def as_integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): rows that are fit, x the integers of their entries."""
    # guarded entry by entry, as Spark may compute this ahead of the filter
    scaled = F.transform(F.col(vector_col), lambda c: F.when(F.abs(c) < LARGEST, (F.floor(F.lit(float(SCALE)) * c.cast("double")) + SHIFT).cast("long")))
    fit = vectors.where(finite(F.col(vector_col)))
    sizes = fit.groupBy(F.size(vector_col).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return fit.where(F.size(vector_col) == (sizes["size"] if sizes else -1)).select(F.col(id_col).alias("id"), scaled.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, with an exact numerator where n times any x fits in 64 bits (sums are integers then)."""
    return (n * (x if sums.dtype.kind == "i" else x.astype(float)) - sums).astype(np.float64) / n


def _summed(rows: DataFrame, width: int, each) -> np.ndarray:
    """The sum over all rows of what ``each`` makes of a batch's matrix: a matrix of few rows and ``width`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = each(_matrix(batch))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.ListArray.from_arrays(np.arange(0, total.size + 1, width, dtype=np.int32), total.ravel())], ["i", "v"])

    found = rows.mapInArrow(run, "i int, v array<double>")
    got = found.groupBy("i").agg(F.array(*(F.sum(F.col("v")[j]) for j in range(width))).alias("v")).orderBy("i").collect()
    return np.array([r["v"] for r in got], float)


def covariance_times(rows: DataFrame, n: int, sums: np.ndarray, q: np.ndarray) -> np.ndarray:
    """V q in one pass over the vectors."""

    def each(x: np.ndarray) -> np.ndarray:
        c = _centred(x, n, sums)
        return c.T @ (c @ q)

    return _summed(rows, q.shape[1], each) / n


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = 0) -> Model | None:
    """Fit on all rows of :func:`as_integers`; None if there are none."""
    dims = rows.select(F.size("x").alias("d")).first()
    if dims is None:
        return None
    d = dims["d"]
    # exact decimals: partial sums and extremes per dimension
    seen = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")).orderBy("i").collect()
    n, sums = seen[0]["n"], [int(r["s"]) for r in seen]
    widest = max(max(abs(n * r["low"] - s), abs(n * r["high"] - s)) for r, s in zip(seen, sums, strict=True))
    exact = d * widest * widest < 1 << 63
    whole = np.array(sums, np.int64 if n * max(max(abs(r["low"]), abs(r["high"])) for r in seen) < 1 << 62 else float)
    trace = float(_summed(rows, 1, lambda x: np.array([[np.square(_centred(x, n, whole)).sum()]]))[0, 0]) / n
    wanted, width = min(components, d), min(d, components + GUARD)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(d, width)))[0]
    before = np.inf
    for _ in range(ROUNDS):
        w = covariance_times(rows, n, whole, q)
        small = q.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        residual = np.linalg.norm(w[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        size = max(values[0], np.finfo(float).tiny)
        if width == d or residual <= TOLERANCE * size or (residual <= LOOSEST * size and residual > 0.5 * before):
            return Model(n, sums, whole, q[:, :wanted], np.maximum(values[:wanted], 0), trace, exact)
        before = residual
        if width > wanted + FRESH:
            q[:, -FRESH:] = rng.normal(size=(d, FRESH))
            q[:, -FRESH:] -= q[:, :-FRESH] @ (q[:, :-FRESH].T @ q[:, -FRESH:])
            q = np.linalg.qr(q)[0]
            w = None
        q = np.linalg.qr(_filtered(rows, n, whole, q, w, max(float(values[-FRESH - 1]), 0.0), float(values[0])))[0]
    raise RuntimeError(f"{wanted} components are not certified after {ROUNDS} rounds")


def _filtered(rows: DataFrame, n: int, sums: np.ndarray, q: np.ndarray, times: np.ndarray | None, edge: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V that is small between 0 and ``edge``, applied to q."""
    half = edge / 2
    if half <= FLAT * top or top <= edge:  # nothing to damp: a power step
        return covariance_times(rows, n, sums, q) if times is None else times
    scale = half / (top - half)
    first = scale
    old, now = q, ((covariance_times(rows, n, sums, q) if times is None else times) - half * q) * (scale / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - scale)
        old, now = now, (covariance_times(rows, n, sums, now) - half * now) * (2 * after / half) - (scale * after) * old
        scale = after
    return now


def _white(model: Model, x: np.ndarray) -> np.ndarray:
    return (_centred(x, model.n, model.whole) @ model.vectors) * model.scales


def identity_error(rows: DataFrame, model: Model) -> float | None:
    """The largest entry of whitened rows' covariance minus the identity, over components with variance."""
    alive = np.flatnonzero(~np.isnan(model.scales))
    if not len(alive):
        return None
    mean = _summed(rows, len(alive), lambda x: _white(model, x)[:, alive].sum(0, keepdims=True))[0] / model.n

    def each(x: np.ndarray) -> np.ndarray:
        c = _white(model, x)[:, alive] - mean
        return c.T @ c

    return float(np.abs(_summed(rows, len(alive), each) / model.n - np.eye(len(alive))).max())


def _deviations(model: Model, x: np.ndarray) -> pa.Array:
    if model.exact:
        return pa.array(np.square(model.n * x - np.array(model.sums, np.int64)).sum(1), pa.int64())
    found = (sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x.tolist())
    return pa.array([v if v < 1 << 63 else None for v in found], pa.int64())


def whiten(rows: DataFrame, model: Model) -> DataFrame:
    """(id, deviation, whitened): an array of the model's components for each row of :func:`as_integers`."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                white = _white(model, x)
                flat = pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel()))
                lists = pa.ListArray.from_arrays(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([batch.column("id"), _deviations(model, x), lists], ["id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = Scratch(spark).publish(as_integers(vectors), "whitening-integers")  # the result reads it; passes read it many times
    model = fit(rows)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(rows, model)
    explained = F.array(*(F.lit(float(e / model.trace) if model.trace else None).cast("double") for e in model.values))
    found = whiten(rows, model).select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
