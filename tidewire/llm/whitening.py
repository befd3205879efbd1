"""Whitening of vectors by an eigendecomposition that grows with the data.

An entry c of a vector becomes the whole number x = floor(64 * c) + 1,000,000.  The covariance V of all vectors (divisor n)
is never formed while they are read; each task keeps a *spectrum*, the eigenvalues and eigenvectors of its scatter:

* A centred rank-one update adds v v' to it: v is turned into the eigenbasis, entries that are negligible or belong to
  equal eigenvalues are deflated (by a rotation), the new eigenvalues are the roots of the secular equation
  1 + sum(z[j] ** 2 / (d[j] - t)) = 0, one between each two old ones, and the new eigenvectors follow from them.
* A vector is one update with sqrt(n / (n + 1)) * (x - mean).  A block of vectors is first reduced to the triangular factor of
  its centred rows, which has the same scatter: at most one update per dimension and one for the shift of the mean,
  whatever the number of rows.  ``block=1`` gives the plain update per vector; results agree.
* Two spectra are combined by an update with each scaled eigenvector of the smaller one and one with the shift of
  the mean.  Tasks' spectra are combined ``FAN`` at a time in staged rounds until one is left.

Its eigenvectors are a basis in which V is nearly diagonal.  A last pass computes V in this basis, every vector centred by the exact
mean, and the small matrix is diagonalized (Rayleigh-Ritz), which removes the rounding of all updates.

Sums are exact whole numbers, and vectors are shifted by the whole part of the mean before any floating-point work.  What
reaches the driver is one spectrum: the square of the dimension, however many vectors there are.

Defined cases: vectors that are null or hold null, non-finite or (beyond ``MOST``) huge entries have no part, nor have empty ones or
those of another length than most (ties: the longer); components run by falling eigenvalue, the entry of largest
size positive; along components without variance (e at most 1e-12 of the trace) everything is 0 and the identity error looks at the
others only; ``deviation`` is null where it doesn't fit a long; repeated rows count each; an empty table gives no
rows; further columns are kept, those named ``deviation`` or ``whitened`` are replaced.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidewire.storage import stage

from .tables import plain_names

SCALE, OFFSET = 64, 1_000_000
#: Largest size of an entry; its multiples and sums stay exact.
MOST = 2.0**34
COMPONENTS = 32
BLOCK = 4096
FAN = 8
NO_VARIANCE = 1e-12
_EPS = np.finfo(np.float64).eps


# --- rank-one updates ---------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z[j] ** 2 / (d[j] - t)) as (index of the nearest pole, distance from it).

    ``d`` rises strictly and no z is 0.  All roots at once, each by interpolation between the poles around it and, where that
    leaves what is known to hold the root, by halving.
    """
    k, squares = len(d), z * z
    index, total = np.arange(k), squares.sum()
    if k == 1:
        return index, total.reshape(1)
    width = np.append(np.diff(d), total)
    right = np.minimum(index + 1, k - 1)
    middle = 1 + (squares[:, None] / ((d[:, None] - d) - width / 2)).sum(axis=0)
    pole = np.where((middle >= 0) | (index == k - 1), index, right)
    from_left = pole == index
    delta = d[:, None] - d[pole]
    low = np.where(from_left, np.where((middle < 0) & (index == k - 1), width / 2, 0.0), -width / 2)
    high = np.where(from_left, np.where((middle < 0) & (index == k - 1), width, width / 2), 0.0)
    below = index[:, None] <= index
    t = (low + high) / 2
    for _ in range(100):
        gaps = delta - t
        terms = squares[:, None] / gaps
        value = 1 + terms.sum(axis=0)
        if (np.abs(value) <= 4 * _EPS * (1 + np.abs(terms).sum(axis=0))).all():
            break
        high, low = np.where(value > 0, t, high), np.where(value > 0, low, t)
        slopes = terms / gaps
        before = (slopes * below).sum(axis=0)
        after = slopes.sum(axis=0) - before
        one, two = gaps[index, index], gaps[right, index]
        with np.errstate(all="ignore"):
            a, b, c = (one + two) * value - one * two * (before + after), one * two * value, value - one * before - two * after
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = one[-1] + one[-1] ** 2 * before[-1] / (value[-1] - one[-1] * before[-1])
            there = t + step
        there = np.where((there > low) & (there < high), there, (low + high) / 2)
        if (there == t).all():
            break
        t = there
    return pole, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of vectors * diag(values) * vectors' + v v'."""
    z = vectors.T @ v
    size = np.sqrt(z @ z)
    least = 8 * _EPS * (values[-1] + size * size)
    if size * size <= least:
        return values, vectors
    values, z = values.copy(), z.copy()
    candidates = np.flatnonzero(np.abs(z) * size > least).tolist()
    kept, copied = [], False
    for j in candidates:
        if kept:
            i = kept[-1]
            both = np.hypot(z[i], z[j])
            c, s = z[j] / both, -z[i] / both
            if abs((values[j] - values[i]) * c * s) <= least:  # as good as equal: all of z goes to j, i is deflated
                if not copied:
                    vectors, copied = vectors.copy(), True
                z[i], z[j] = 0.0, both
                vectors[:, i], vectors[:, j] = c * vectors[:, i] + s * vectors[:, j], c * vectors[:, j] - s * vectors[:, i]
                values[i], values[j] = values[i] * c * c + values[j] * s * s, values[i] * s * s + values[j] * c * c
                kept.pop()
        kept.append(j)
    d, w = values[kept], z[kept]
    pole, t = secular_roots(d, w)
    gaps = (d[:, None] - d[pole]) - t  # d[j] - root[i]
    apart = d[:, None] - d
    np.fill_diagonal(apart, -1.0)
    exact = np.sqrt(np.abs(np.prod(gaps / apart, axis=1)))  # the z for which these roots are exact: keeps the vectors orthogonal
    turned = np.copysign(exact, w)[:, None] / gaps
    turned /= np.sqrt((turned * turned).sum(axis=0))
    result, found = vectors.copy(), values
    result[:, kept] = vectors[:, kept] @ turned
    found[kept] = d[pole] + t
    order = np.argsort(found, kind="stable")
    return found[order], result[:, order]


@dataclasses.dataclass
class Spectrum:
    """Number, mean, eigenvalues (rising) and eigenvectors (columns) of the scatter of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimension: int) -> Spectrum:
        return cls(0, np.zeros(dimension), np.zeros(dimension), np.eye(dimension))

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        if self.n:
            self._update(np.sqrt(self.n * n / (self.n + n)) * (mean - self.mean))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        if len(rows) > 1:
            for r in np.linalg.qr(rows - mean, mode="r"):
                self._update(r)
        self._shift(len(rows), mean)

    def combine(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self._update(np.sqrt(value) * vector)
        self._shift(other.n, other.mean)


# --- tasks --------------------------------------------------------------------------


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    n, sums = 0, np.zeros(dimension, dtype=object)
    for batch in batches:
        rows = _matrix(batch.column(0), dimension)
        for at in range(0, len(rows), BLOCK):
            sums += rows[at : at + BLOCK].sum(axis=0).astype(object)
        n += len(rows)
    if n:
        found = pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([n] * dimension), found], ["k", "n", "s"])


_SPECTRUM = "id long, n long, mean array<double>, values array<double>, vectors array<double>"


def _row(number: int, s: Spectrum) -> pa.Table:
    lists = [pa.array([x.ravel()], pa.list_(pa.float64())) for x in (s.mean, s.values, s.vectors)]
    return pa.Table.from_arrays([pa.array([number], pa.int64()), pa.array([s.n], pa.int64()), *lists], ["id", "n", "mean", "values", "vectors"])


def _spectrum(batches: Iterator[pa.RecordBatch], origin: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    found = Spectrum.empty(len(origin))
    for batch in batches:
        rows = (_matrix(batch.column(0), len(origin)) - origin).astype(np.float64)
        for at in range(0, len(rows), block):
            found.add(rows[at : at + block])
    if found.n:
        yield from _row(TaskContext.get().partitionId(), found).to_batches()


def _combined(rows: pa.Table) -> pa.Table:
    spectra = []
    for r in rows.sort_by("id").to_pylist():
        d = len(r["mean"])
        spectra.append(Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), np.array(r["vectors"]).reshape(d, d)))
    for other in spectra[1:]:
        spectra[0].combine(other)
    return _row(rows.column("id")[0].as_py() // FAN, spectra[0])


def _products(batches: Iterator[pa.RecordBatch], project: Callable[[np.ndarray], np.ndarray], dimension: int) -> Iterator[pa.RecordBatch]:
    """Sums of the products of projected entries, i <= j."""
    total = 0
    for batch in batches:
        rows = _matrix(batch.column(0), dimension)
        for at in range(0, len(rows), BLOCK):
            p = project(rows[at : at + BLOCK])
            total = total + p.T @ p
    if not np.isscalar(total):
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])


def covariance(known: DataFrame, project: Callable[[np.ndarray], np.ndarray], dimension: int, n: int) -> np.ndarray:
    """Covariance of the projections of ``x``, which ``project`` centres."""
    sums = known.select("x").mapInArrow(lambda b: _products(b, project, dimension), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v"))
    found = sums.collect()  # the square of the number of projections
    size = max(r[0] for r in found) + 1
    result = np.zeros((size, size))
    for i, j, v in found:
        result[i, j] = result[j, i] = v / n
    return result


# --- the model ----------------------------------------------------------------------


@dataclasses.dataclass
class Model:
    """Fitted to ``n`` vectors; ``components`` are columns by falling eigenvalue, all of them."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    most: int = COMPONENTS
    identity_error: float = 0.0

    def __post_init__(self):
        self.origin = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % self.n for s in self.sums], dtype=np.int64)

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        trace = float(self.values.sum())
        return [float(max(v, 0.0)) / trace if trace > 0 else 0.0 for v in self.values[: self.most]]

    def varied(self) -> np.ndarray:
        return self.values[: self.most] > NO_VARIANCE * self.values.sum()

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.origin) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        varied = self.varied()
        scale = np.where(varied, 1 / np.sqrt(np.where(varied, self.values[: self.most], 1.0)), 0.0)
        return self.centred(x) @ (self.components[:, : self.most] * scale)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2."""
        shifted = x - self.origin
        if not len(shifted) or (int(np.abs(shifted).max()) + 1) ** 2 * self.n**2 * self.dimension < 1 << 63:
            return ((self.n * shifted - self.rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, self.rest.tolist(), strict=True)) for row in shifted.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def integers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Adds ``x`` to the rows whose vector has a part, staged."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > MOST))
    usable = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad)
    number = F.transform(column, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    known = stage(usable.withColumn("x", number), "whitening-vectors")
    length = known.groupBy(F.size("x").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("k")).first()
    return known.filter(F.size("x") == length["k"]) if length else known


def spectrum(known: DataFrame, origin: np.ndarray, block: int = BLOCK) -> Spectrum:
    """The spectrum of ``x - origin`` over all rows: one per task, combined in rounds."""
    found = stage(known.select("x").mapInArrow(lambda b: _spectrum(b, origin, block), _SPECTRUM), "whitening-spectra")
    most = found.agg(F.max("id")).first()[0]
    while most:
        # A group has FAN rows at most, one for each number.
        found = stage(found.groupBy(F.expr(f"id div {FAN}")).applyInArrow(lambda rows: _combined(rows), _SPECTRUM), "whitening-spectra")
        most //= FAN
    r = found.first()
    d = len(r["mean"])
    return Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), np.array(r["vectors"]).reshape(d, d))


def fit(known: DataFrame, *, most: int = COMPONENTS, block: int = BLOCK) -> Model | None:
    """The model of rows with ``x`` (see ``integers``); None without rows."""
    first = known.select(F.size("x")).first()
    if first is None:
        return None
    dimension = first[0]
    sums = known.select("x").mapInArrow(lambda b: _sums(b, dimension), "k int, n long, s decimal(38,0)")
    total = sums.groupBy("k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("k").collect()  # one row per dimension
    model = Model(total[0]["n"], [int(r["s"]) for r in total], np.zeros(dimension), np.eye(dimension), most)

    basis, _ = np.linalg.qr(spectrum(known, model.origin, block).vectors[:, ::-1])
    centred = model.centred
    values, turned = np.linalg.eigh(covariance(known, lambda x: centred(x) @ basis, dimension, model.n))
    components = (basis @ turned)[:, ::-1]
    components *= np.sign(components[np.abs(components).argmax(axis=0), np.arange(dimension)])
    model.values, model.components = values[::-1], components

    whitened, varied = model.whitened, model.varied()
    if varied.any():
        found = covariance(known, whitened, dimension, model.n)[varied][:, varied]
        model.identity_error = float(np.abs(found - np.eye(len(found))).max())
    return model


def _transformed(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(batch.num_columns - 1), model.dimension)
        projected = model.whitened(x)
        ends = np.arange(0, projected.size + 1, max(projected.shape[1], 1), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(projected.ravel()))
        names = [*batch.schema.names[:-1], "deviation", "whitened"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.deviation(x), pa.int64()), lists], names)


def whiten(vectors: DataFrame, *, column: str = "embedding", most: int = COMPONENTS, block: int = BLOCK) -> tuple[DataFrame, Model | None]:
    """Rows whose vector has a part, with ``deviation`` and ``whitened`` (entries of the first ``most`` components), and the model."""
    added = ("deviation", "whitened")
    given = [c for c in vectors.columns if c not in added]
    plain = plain_names(vectors.drop(*added), column)
    known = integers(plain, column)
    model = fit(known, most=most, block=block)
    fields = [StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))]
    schema = StructType([*plain.schema.fields, *fields])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).toDF(*given, *added), None
    return known.mapInArrow(lambda b: _transformed(b, model), schema).toDF(*given, *added), model
