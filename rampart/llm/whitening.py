"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

A vector's entries become integers floor(scale * c) + offset.  The fit list holds each
distinct vector once.

1. Tasks sum the fit list, then its centred products: integers less the rounded mean, so
   the products are exact, and their sums are carried as pairs of doubles (106 bits).
   Matrices are cut into bands of rows and added band by band in two levels; the driver
   gets one matrix of width x width.
2. Eigenvectors are computed in float32 and corrected by Ogita-Aishima iterations, which
   are matrix products, in the widest float of the machine (80 bits on x86).
3. Eigenvalues too close for the iteration are a cluster: the matrix, projected on the
   cluster's vectors and shifted by its eigenvalue, is solved by itself, where the small
   differences count in full; iterations follow.  Exactly equal eigenvalues keep the basis
   that the sub-solve gives.
4. Rows are projected in tasks; the covariance of the whitened fit list is measured by the
   same distributed sums.

Rows: vectors that are NULL, empty, or hold a NULL or non-finite entry are left out.
Repeated rows and ids, and NULL ids, are rows of their own; equal vectors count once in the
fit.  Vectors of different widths are different spaces: each width has a fit, n and
components of its own.  A component whose eigenvalue is zero (a share under ``NOTHING`` of
the greatest) has whitened NULL and explained 0 (NULL if all vectors are equal).  Entries
of 2^52 or more after scaling are an error.  Other columns are not used.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import staged
from rampart.llm.pq import usable

BAND = 64
FAN_IN = 64
ROWS_AT_ONCE = 2_048
GREATEST = float(1 << 52)
NOTHING = 1e-14
ITERATIONS = 12
WIDE = np.longdouble

_OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"
_BAND = "band int, part int, high binary, low binary"


# ---------------------------------------------------------- the symmetric eigenproblem
def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix of
    ``WIDE`` floats, to more than double precision where eigenvalues differ."""
    size = len(v)
    scale = np.abs(v).max() if size else WIDE(0)
    if not size or scale == 0:
        return np.zeros(size, WIDE), np.eye(size, dtype=WIDE)
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    x, values = refined(a, x, None)
    groups = clusters_of(a, x, values)
    if any(len(g) > 1 for g in groups):
        for _ in range(3):
            x = _sub_solved(a, x, groups)
            x, values = refined(a, x, groups)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order] * scale, x / np.sqrt((x * x).sum(axis=0))


def refined(a: np.ndarray, x: np.ndarray, groups: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Ogita-Aishima: corrections of all columns by two matrix products a round, until the
    correction no longer shrinks.  Columns of one group are only made orthonormal: their
    directions within the group are left to the sub-solve."""
    one, last = np.eye(len(a), dtype=WIDE), np.inf
    kept, values = x, (x * (a @ x)).sum(axis=0)
    for _ in range(ITERATIONS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        off = np.abs(s - np.diag(values)).copy()
        np.fill_diagonal(off, 0)
        near = 2 * (_norm(off) + _norm(r))
        together = np.abs(gap) <= max(near, 64 * np.finfo(WIDE).eps)
        if groups is not None:
            together[:] = False
            for g in groups:
                together[np.ix_(g, g)] = True
        np.fill_diagonal(together, True)
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.where(together, r / 2, (s + values[None, :] * r) / np.where(together, 1, gap))
        size = _norm(e)
        if not np.isfinite(size) or size >= last:
            return kept, values
        kept, last = x, size
        x = x + x @ e
        if size < 4 * np.finfo(WIDE).eps:
            break
    return x, values


def _norm(m: np.ndarray) -> float:
    return float(np.sqrt((m * m).sum()))


def clusters_of(a: np.ndarray, x: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Columns whose eigenvalues are too close for the iteration to have told them apart:
    neighbours closer than 1e-4 of the greatest, in chains."""
    order = np.argsort(values)
    close = np.diff(values[order]) <= 1e-4 * np.abs(values).max()
    return np.split(order, np.flatnonzero(~close) + 1)


def _sub_solved(a: np.ndarray, x: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """Within each cluster, the eigenvectors of the projected and shifted matrix."""
    x = x.copy()
    for g in groups:
        if len(g) < 2:
            continue
        basis = _orthonormal(x[:, g])
        small = basis.T @ (a @ basis)
        shift = np.trace(small) / len(g)
        small = small - shift * np.eye(len(g), dtype=WIDE)
        small = (small + small.T) / 2
        size = np.abs(small).max()
        if size <= 16 * np.finfo(WIDE).eps:
            x[:, g] = basis
            continue
        turn = np.linalg.eigh((small / size).astype(np.float64))[1].astype(WIDE)
        inner = [np.array([k]) for k in range(len(g))]
        turn, found = refined(small / size, turn, None)
        inner = clusters_of(small, turn, found)
        # A cluster within the cluster: once more, unless nothing was told apart.
        if 1 < len(inner) < len(g):
            turn = _sub_solved(small / size, turn, inner)
        x[:, g] = basis @ turn
    return x


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made so, by Newton-Schulz steps."""
    one = np.eye(x.shape[1], dtype=WIDE)
    for _ in range(4):
        x = x + x @ (one - x.T @ x) / 2
    return x


# ------------------------------------------------------------------- distributed sums
def _two_sum(high: np.ndarray, low: np.ndarray, more_high: np.ndarray, more_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two pairs of doubles."""
    total = high + more_high
    part = total - high
    rest = (high - (total - part)) + (more_high - part) + low + more_low
    new = total + rest
    return new, rest - (new - total)


def _products(rows: DataFrame, column: str, width: int, centred) -> np.ndarray:
    """Sum of the outer products of all rows' vectors, as ``WIDE`` floats.

    ``centred`` maps a matrix of the column's values to the doubles to multiply.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros((width, width)), np.zeros((width, width))
        for batch in batches:
            flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                y = centred(flat[first : first + ROWS_AT_ONCE])
                high, low = _two_sum(high, low, y.T @ y, np.zeros_like(low))
        part = TaskContext.get().partitionId()
        for band in range(-(-width // BAND)):
            cut = slice(band * BAND, (band + 1) * BAND)
            columns = [pa.array([band], pa.int32()), pa.array([part], pa.int32())]
            columns += [pa.array([m[cut].tobytes()], pa.binary()) for m in (high, low)]
            yield pa.RecordBatch.from_arrays(columns, names=["band", "part", "high", "low"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        high = low = 0.0
        for a, b in zip(frame["high"], frame["low"]):
            high, low = _two_sum(high, low, np.frombuffer(a), np.frombuffer(b))
        first = frame.iloc[0]
        return pd.DataFrame({"band": [first["band"]], "part": [first["part"] // FAN_IN], "high": [high.tobytes()], "low": [low.tobytes()]})

    bands = rows.select(column).mapInArrow(partial, _BAND)
    few = bands.groupBy("band", F.floor(F.col("part") / FAN_IN)).applyInPandas(add, _BAND)
    total = few.groupBy("band").applyInPandas(add, _BAND).orderBy("band").collect()
    wide = [np.frombuffer(r.high).astype(WIDE) + np.frombuffer(r.low) for r in total]
    return np.concatenate(wide).reshape(width, width) if wide else np.zeros((width, width), WIDE)


class Fit:
    """What the fit list of one width says: its size, sums, covariance and components."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, components: int) -> None:
        self.n = n
        self.middle = middles(n, sums)
        # n * mean less n * middle: what the rounding of the means has left.
        self.rest = [s - n * m for s, m in zip(sums, self.middle)]
        apart = np.array([WIDE(r) for r in self.rest], WIDE) / n
        self.covariance = products / n - apart[:, None] * apart[None, :]
        values, vectors = eigenvectors(self.covariance)
        trace = np.trace(self.covariance)
        self.components = min(components, len(sums))
        top = values[0] if len(values) else WIDE(0)
        self.there = (values > NOTHING * top)[: self.components]
        kept = values[: self.components]
        self.explained = (kept / trace).astype(np.float64) if trace > 0 else np.full(self.components, np.nan)
        self.explained[~self.there & np.isfinite(self.explained)] = 0.0
        root = np.sqrt(np.where(self.there, kept, 1))
        self.basis = (vectors[:, : self.components] / root).astype(np.float64)

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """x less the mean, and the exact sums of (n * x - S)^2."""
        apart = x - np.array(self.middle, np.int64)
        top = max(int(np.abs(apart).max(initial=0)), 1) * self.n + max(map(abs, self.rest), default=0)
        if top < 1 << 62:
            whole = self.n * apart - np.array(self.rest, np.int64)
            fits = top * top * max(1, x.shape[1]) < 1 << 63
            squares = (whole * whole).sum(axis=1) if fits else (whole.astype(object) ** 2).sum(axis=1)
            return whole / self.n, [int(s) for s in squares]
        whole = self.n * apart.astype(object) - np.array(self.rest, object)
        return (whole / self.n).astype(np.float64), [int(s) for s in (whole**2).sum(axis=1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x)[0] @ self.basis


def middles(n: int, sums: list[int]) -> list[int]:
    """The means, rounded to integers."""
    return [(2 * s + n) // (2 * n) for s in sums]


def whiten(vectors: DataFrame, *, scale: int, offset: int, components: int = 16) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding) that takes part and component: vec_id,
    component (from 1), n, deviation, whitened, explained and identity_error (the greatest
    absolute entry of the whitened fit list's covariance less the identity)."""
    spark = vectors.sparkSession
    entries = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), entries.alias("embedding")).where(usable(F.col("embedding")) & (F.size("embedding") > 0))
    too_great = F.raise_error(F.lit(f"an entry times {scale} is 2^52 or more"))
    whole = F.transform("embedding", lambda c: F.when(F.abs(c * scale) < GREATEST, F.floor(c * scale) + offset).otherwise(too_great.cast("long")))
    rows = staged(rows.select("vec_id", whole.alias("x")).withColumn("width", F.size("x")), "whole-vectors")
    fit_list = staged(rows.select("width", "x").distinct(), "fit-list")
    out = None
    # One row per width and dimension.
    place = fit_list.select("width", F.posexplode("x").alias("place", "x"))
    sums = place.groupBy("width", "place").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")).collect()
    for width in sorted({r.width for r in sums}):
        own = sorted((r for r in sums if r.width == width), key=lambda r: r.place)
        n, totals = own[0].n, [int(r.total) for r in own]
        middle = np.array(middles(n, totals), np.int64)
        mine = fit_list.where(F.col("width") == width)
        products = _products(mine, "x", width, lambda x, middle=middle: (x - middle).astype(np.float64))
        fit = Fit(n, totals, products, components)
        shared = spark.sparkContext.broadcast(fit)
        measured = _products_of(mine, width, shared)
        there = fit.there
        wrong = np.abs(measured / n - np.eye(fit.components, dtype=WIDE))[np.ix_(there, there)]
        error = float(wrong.max()) if wrong.size else 0.0
        found = rows.where(F.col("width") == width).select("vec_id", "x").mapInArrow(_projection(shared, width), _OUT)
        found = found.withColumn("identity_error", F.lit(error))
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"{_OUT}, identity_error double") if out is None else out


def _products_of(rows: DataFrame, width: int, shared) -> np.ndarray:
    """Sum of the outer products of the whitened rows."""

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            y = shared.value.whitened(x)
            offsets = np.arange(0, y.size + 1, y.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.reshape(-1)))], names=["y"])

    count = shared.value.components
    return _products(rows.select("x").mapInArrow(whitened, "y array<double>"), "y", count, lambda y: y)


def _projection(shared, width: int):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        count = fit.components
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            centred, squares = fit.deviations(x)
            values = centred @ fit.basis
            rows = np.repeat(np.arange(batch.num_rows), count)
            gone = np.tile(~fit.there, batch.num_rows)
            deviation = pa.array([Decimal(s) for s in squares], pa.decimal128(38, 0))
            explained = np.tile(fit.explained, batch.num_rows)
            columns = [
                batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(rows), fit.n, np.int64)), deviation.take(pa.array(rows)),
                pa.array(values.reshape(-1), mask=gone), pa.array(explained, mask=np.isnan(explained)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return project
