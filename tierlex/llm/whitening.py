"""Whitening of embedding vectors by a randomised range finder.

Entries become whole numbers, so sums and means are exact and centring loses nothing.  A seeded random
block, wider than the components that are wanted, is multiplied by the covariance in passes over all
centred rows, made orthonormal on the driver between passes; Rayleigh-Ritz on the block then gives pairs
of eigenvalue and vector.  They are taken only if their residuals are of rounding's size and the variance
outside the block is below the last one's, which proves that none is missing; else the block is expanded
to all dimensions, in which one more pass makes the pairs exact.

What comes to the driver is a block of dimension x width numbers, summed by the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, durable, ship

COMPONENTS, OVERSAMPLE, PASSES, SEED = 32, 10, 3, 11
#: Residual, as a share of the largest eigenvalue, up to which a pair counts as exact.
RESIDUAL = 1e-13
#: An entry c becomes floor(STEPS * c) + OFFSET.
STEPS, OFFSET = 64, 1_000_000


class Whitening(NamedTuple):
    """n fitted rows; means are whole + part (0 to 1, kept as the number rest / n); unit components in columns, by falling variance."""

    n: int
    whole: np.ndarray
    rest: list[int]
    variances: np.ndarray
    components: np.ndarray
    total: float
    width: int
    passes: int

    @property
    def usable(self) -> np.ndarray:
        """Components that have variance beyond rounding; the others can't be scaled to 1."""
        floor = len(self.whole) * np.finfo(float).eps * max(self.variances, default=0.0)
        return self.variances > floor

    def centred(self, y: np.ndarray) -> np.ndarray:
        return y - np.array([r / self.n for r in self.rest])

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN in a component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.usable, (self.centred(y) @ self.components) / np.sqrt(self.variances), np.nan)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A durable table of vec_id and x, the vectors in whole numbers; rows without a usable vector are left out.

    Left out are null vectors and those with an entry that is null, not finite, or beyond 2**62 / STEPS.
    """
    bound_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            entries = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]  # a null is NaN
            at = at - at[0]
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(entries * float(STEPS))
                wrong = np.append(0, np.cumsum(~(np.abs(x) < float(1 << 62))))
            good = (wrong[at[1:]] == wrong[at[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(at)
            x = x[np.repeat(good, sizes)].astype(np.int64) + OFFSET
            out = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes[good])).astype(np.int32)), pa.array(x, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), out], ["vec_id", "x"])

    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return durable(slim.mapInArrow(run, "vec_id long, x array<long>"))


def _matrix(column: pa.ListArray, d: int, origin: np.ndarray) -> np.ndarray:
    """Rows of d whole numbers less the origin; a shorter vector goes on with entries of 0.0."""
    at = column.offsets.to_numpy().astype(np.int64)
    sizes, entries = np.diff(at), column.values.to_numpy()[at[0] : at[-1]]
    if (sizes == d).all():
        return entries.reshape(-1, d) - origin
    out = np.full((len(sizes), d), OFFSET, np.int64)
    out[np.arange(d) < sizes[:, None]] = entries
    return out - origin


def _summed(rows: DataFrame, d: int, origin: np.ndarray, cells: int, add: Callable[[np.ndarray, np.ndarray], None]) -> np.ndarray:
    """Sums over all rows: add(sums, matrix) adds a batch to a task's sums, which are then added by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some = np.zeros(cells), False
        for batch in batches:
            if batch.num_rows:
                some = True
                add(sums, _matrix(batch.column(0), d, origin))
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(sums)], ["cell", "value"])

    found = rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(cells)
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return out


def _exact_sums(rows: DataFrame, d: int) -> list[int]:
    """Sum of each dimension, in whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d, np.zeros(d, np.int64))
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low)], ["cell", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    found = rows.select("x").mapInArrow(run, "cell int, high long, low long").groupBy("cell").agg(wide("high"), wide("low")).collect()
    return [int(r.high) * (1 << 32) + int(r.low) for r in sorted(found, key=lambda r: r.cell)]


def fit(rows: DataFrame, components: int = COMPONENTS, oversample: int = OVERSAMPLE, passes: int = PASSES, seed: int = SEED) -> Whitening | None:
    """The whitening of a table from `whole_vectors`; None if it has no dimension at all."""
    n, d = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n or not d:
        return None
    sums = _exact_sums(rows, d)
    whole, rest = np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    spark, done = rows.sparkSession, 0
    part = np.array([r / n for r in rest])

    def times_covariance(block: np.ndarray) -> tuple[np.ndarray, float]:
        """Covariance x block, and the covariance's trace."""
        nonlocal done
        done += 1
        width = block.shape[1]
        sent = ship(spark, block)

        def add(total: np.ndarray, y: np.ndarray) -> None:
            c = y - part
            total[:-1] += (c.T @ (c @ sent())).ravel()
            total[-1] += np.einsum("ij,ij->", c, c)

        total = _summed(rows, d, whole, d * width + 1, add) / n
        return total[:-1].reshape(d, width), float(total[-1])

    def rayleigh_ritz(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        image, trace = times_covariance(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors = block @ turn
        off = np.linalg.norm(image @ turn[:, :k] - vectors[:, :k] * values[:k], axis=0)
        proven = block.shape[1] == d or (off.max() <= RESIDUAL * values[0] and trace - values.sum() <= values[k - 1])
        return np.maximum(values[:k], 0), vectors[:, :k], proven, trace

    k = min(components, d)
    width = min(d, k + oversample)
    if width < d:
        block = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
        for _ in range(passes):
            block = np.linalg.qr(times_covariance(block)[0])[0]
        values, vectors, proven, trace = rayleigh_ritz(block)
    if width == d or not proven:
        width = d
        values, vectors, _, trace = rayleigh_ritz(np.eye(d))
    return Whitening(n, whole, rest, values, vectors, trace, width, done)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components that have variance."""
    k, sent = len(model.variances), ship(rows.sparkSession, model)

    def add(total: np.ndarray, y: np.ndarray) -> None:
        w = np.nan_to_num(sent().project(y))
        total[:k] += w.sum(0)
        total[k:] += (w.T @ w).ravel()

    total = _summed(rows, len(model.whole), model.whole, k + k * k, add) / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])  # the rows are centred: their mean is a rounding error
    off = np.abs(covariance - np.eye(k))[np.ix_(model.usable, model.usable)]
    return float(off.max()) if off.size else 0.0


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * y - rest)**2 in whole numbers; None where it is no 64-bit number."""
    most = (int(np.abs(y).max(initial=0)) + 1) * n
    if most * most * max(1, y.shape[1]) < 1 << 63:
        z = y * n - np.array(rest, np.int64)
        return np.einsum("ij,ij->i", z, z).tolist()
    sums = (sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in y.tolist())
    return [s if s < 1 << 63 else None for s in sums]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (sum of squares of n * x - S, exact) and whitened (an entry for each component, null without variance)."""
    sent = ship(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent()
        for batch in batches:
            y = _matrix(batch.column(1), len(m.whole), m.whole)
            w = m.project(y)
            at = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviations(y, m.n, m.rest), pa.int64()), pa.ListArray.from_arrays(at, pa.array(w.ravel(), from_pandas=True))], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    All usable rows are fitted and returned, repeated ones and those with a null vec_id too; see
    `whole_vectors` for those left out.  A vector shorter than the longest goes on with entries of 0.0.
    A component without variance (one row, equal rows, fewer dimensions in use) has whitened null.
    A deviation that is no 64-bit number is null.  Equal eigenvalues leave their components' order open.
    An empty table, or one of empty vectors, gives no rows.  Other columns are not looked at.
    """
    rows = whole_vectors(vectors, id_col, vector_col)
    model = fit(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*(F.lit(float(e / model.total) if model.total else 0.0) for e in model.variances))
    each = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("nth", "whitened"))
    return each.select("vec_id", (F.col("nth") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("nth")).alias("explained"), F.lit(identity_error(rows, model)).alias("identity_error"))
