"""Whitening of vectors by an incremental eigendecomposition.

Entries are coded as whole numbers, so sums and deviations are exact. Each partition keeps the spectrum of what it has
seen: number of rows, exact sums, eigenvalues and eigenvectors of the centred scatter. It grows by rank-one updates:
the new eigenvalues are the roots of a secular equation, the eigenvectors follow from them; directions that the update
does not touch, and eigenvalues too close to tell apart, are deflated. A block of rows enters as the rows of its
triangular factor, which has the same centred scatter (``block=1``: every row by itself), and one update more for the
distance of the two means. Spectra of partitions are combined in rounds in the same way: one update for each direction
of the other spectrum and one for the means. Last comes a Rayleigh-Ritz step over all rows: the covariance is projected on
the combined eigenvectors, task by task, and the small matrix that is the sum of it turns them to double precision.

Defined results: the dimension is the largest length of a vector without null or non-finite entries; rows whose vector
is null, empty, shorter, or holds null or non-finite entries are dropped. A component whose eigenvalue is not above
rounding (1e-12 of the largest) has no whitened value and is not returned; one row, or equal rows only, give none. Rows
with equal ids are rows of their own. An entry whose code, or a deviation that, exceeds 63 bits is an error. An empty
table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import sum_arrays
from marketlake.session import stage

SCALE, ORIGIN = 64, 1_000_000
COMPONENTS = 32
BLOCK = 4096
EPS = float(np.finfo(float).eps)
#: Eigenvalues at or below this share of the largest are rounding.
RANK = 1e-12


def secular_roots(poles: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z2 / (poles - x)), each as the number of its nearest pole and the distance from it.

    ``poles`` rise and are distinct, ``z2`` is positive and adds up to 1. There is a root behind each pole. All are
    looked for at once, by interpolation with the two poles around and by halving where that leaves the bracket.
    """
    n = len(poles)
    row = np.arange(n)
    width = np.append(np.diff(poles), rho)
    inverse = 1 / rho
    half = poles + width / 2
    middle = inverse + (z2[:, None] / (poles[:, None] - half[None, :])).sum(axis=0)
    near = row.copy()
    right = (middle < 0) & (row < n - 1)  # the root is in the upper half: count from the pole above
    near[right] += 1
    gap = poles[:, None] - poles[near][None, :]
    low = np.where(right, -width / 2, np.where(middle < 0, width / 2, 0.0))
    high = np.where(right, 0.0, np.where(middle < 0, width, width / 2))
    x = (low + high) / 2
    below = row[:, None] <= row[None, :]  # the pole is at or below the root
    below[:, n - 1] = row < max(n - 1, 1)  # behind the last pole: the last one against all others
    first, second = np.minimum(row, max(n - 2, 0)), np.minimum(row + 1, n - 1)
    done = np.zeros(n, bool)
    with np.errstate(all="ignore"):
        for _ in range(80):
            away = gap - x
            term = z2[:, None] / away
            slope = term / away
            f = inverse + term.sum(axis=0)
            bound = inverse + np.abs(term).sum(axis=0)
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            done |= (np.abs(f) <= 2 * EPS * n * bound) | (high - low <= 2 * EPS * np.abs(x))
            if done.all():
                break
            psi = np.where(below, slope, 0.0).sum(axis=0)
            phi = slope.sum(axis=0) - psi
            d1, d2 = away[first, row], away[second, row]
            c = f - d1 * psi - d2 * phi
            a = (d1 + d2) * f - d1 * d2 * (psi + phi)
            b = d1 * d2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            if n > 1:
                last = np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root))
                step[n - 1] = last[n - 1]
            new = x + step
            x = np.where(done, x, np.where((new > low) & (new < high), new, (low + high) / 2))
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of V diag(values) V' + u u'."""
    z = vectors.T @ u
    rho = float(z @ z)
    if rho == 0:
        return values, vectors
    z = z / np.sqrt(rho)
    tiny = 8 * EPS * max(float(np.abs(values).max()), rho)
    # Deflation: of eigenvalues that cannot be told apart, a reflection leaves one direction that the update touches.
    close = np.flatnonzero(np.diff(values) <= tiny)
    if len(close):
        vectors = vectors.copy()
        for part in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
            at = np.arange(part[0], part[-1] + 2)
            w = z[at].copy()
            size = np.linalg.norm(w)
            if size > 0:
                w[-1] += np.copysign(size, w[-1])
                w /= np.linalg.norm(w)
                vectors[:, at] -= 2 * np.outer(vectors[:, at] @ w, w)
                new = z[at] - 2 * (z[at] @ w) * w
                z[at] = 0
                z[at[-1]] = new[-1]
    # A direction that the update hardly touches stays as it is.
    on = np.flatnonzero(rho * np.abs(z) > tiny)
    if not len(on):
        return values, vectors
    poles, z2 = values[on], z[on] ** 2
    share = z2.sum()
    near, x = secular_roots(poles, z2 / share, rho * share)
    # Roots minus poles, without cancellation; weights are taken anew from the roots, so eigenvectors are orthogonal.
    away = (poles[near][None, :] - poles[:, None]) + x[None, :]
    n = len(on)
    apart = poles[None, :] - poles[:, None]
    under = np.ones((n, n))
    under[:, :-1] = np.where(np.tri(n, n - 1, -1, bool), apart[:, :-1], apart[:, 1:])
    weight = np.prod(away / under, axis=1)
    turn = np.sqrt(np.abs(weight))[:, None] * np.sign(z[on])[:, None] / away
    turn /= np.linalg.norm(turn, axis=0)
    values, vectors = values.copy(), vectors.copy()
    values[on] = poles[near] + x
    vectors[:, on] = vectors[:, on] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Rows, exact sums of their entries, eigenvalues (rising) and eigenvectors of their centred scatter."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def none(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def _joined(self, n: int, sums: np.ndarray, directions: np.ndarray) -> Spectrum:
        """With the rows of another set that has ``directions`` as a factor of its centred scatter."""
        values, vectors = self.values, self.vectors
        updates = list(directions)
        if self.n and n:
            updates.append((sums / n - self.sums / self.n) * np.sqrt(self.n * n / (self.n + n)))
        for u in updates:
            values, vectors = rank_one(values, vectors, u)
        return Spectrum(self.n + n, self.sums + sums, values, vectors)

    def with_rows(self, rows: np.ndarray) -> Spectrum:
        n, sums = len(rows), rows.sum(axis=0)
        centred = rows - sums / n
        return self._joined(n, sums, np.linalg.qr(centred, "r") if n > 1 else centred[:0])

    def with_other(self, other: Spectrum) -> Spectrum:
        return self._joined(other.n, other.sums, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)


_SPECTRUM = "n long, sums binary, values binary, vectors binary"


def _row_of(s: Spectrum) -> list:
    return [s.n, s.sums.tobytes(), s.values.tobytes(), np.ascontiguousarray(s.vectors).tobytes()]


def _spectrum_of(n: int, sums: bytes, values: bytes, vectors: bytes) -> Spectrum:
    values = np.frombuffer(values)
    return Spectrum(int(n), np.frombuffer(sums, np.int64), values, np.frombuffer(vectors).reshape(len(values), -1))


def _codes(batch: pa.RecordBatch, size: int, name: str = "x") -> np.ndarray:
    return batch.column(batch.schema.names.index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _partition(size: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum.none(size)
        for batch in batches:
            rows = _codes(batch, size) - ORIGIN
            for low in range(0, len(rows), block):
                s = s.with_rows(rows[low : low + block])
        if s.n:
            yield pa.RecordBatch.from_arrays([pa.array([s.n]), *[pa.array([x], pa.binary()) for x in _row_of(s)[1:]]], names=["n", "sums", "values", "vectors"])

    return run


def spectrum(codes: DataFrame, size: int, block: int = BLOCK, fan: int = 16) -> Spectrum:
    """The combined spectrum of ``codes`` (x: array<long>), about ORIGIN; ``fan`` spectra are combined by a task at a time."""

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        whole = Spectrum.none(size)
        for row in frame[["n", "sums", "values", "vectors"]].itertuples(index=False):
            whole = whole.with_other(_spectrum_of(*row))
        return pd.DataFrame([_row_of(whole)], columns=["n", "sums", "values", "vectors"])

    parts = stage(codes.select("x").mapInArrow(_partition(size, block), _SPECTRUM).withColumn("part", F.monotonically_increasing_id()), "spectra")
    while (n := parts.count()) > 1:
        keyed = parts.withColumn("k", F.pmod(F.xxhash64("part"), F.lit(-(-n // fan))))
        parts = keyed.groupBy("k").applyInPandas(lambda f: combine(f), _SPECTRUM)
        parts = stage(parts.withColumn("part", F.monotonically_increasing_id()), "spectra")
    row = parts.first()
    return Spectrum.none(size) if row is None else _spectrum_of(*row[:4])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean; the whole numbers n * x - sums are exact."""
    return (n * x - sums) / n


def _projected(size: int, n: int, sums: np.ndarray, basis):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = _centred(_codes(batch, size), n, sums) @ basis.value
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    return run


def _whitened(size: int, n: int, sums: np.ndarray, turn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = n * _codes(batch, size) - sums
            if len(far) and size * float(np.abs(far).max()) ** 2 >= 2.0**63:
                raise OverflowError("a deviation needs more than 63 bits")
            y = (far / n) @ turn.value
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index("vec_id")), pa.array((far * far).sum(axis=1)), rows], names=["vec_id", "deviation", "whitened"])

    return run


def _moments(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _codes(batch, k, "whitened")
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    return run


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    vec = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    # A code that does not fit is an error of the cast, as floor() would give the largest number instead.
    code = F.transform(vec, lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(ORIGIN).cast("long"))
    too_far = F.exists(vec, lambda c: F.abs(c) >= 2.0**55)
    code = F.when(too_far, F.raise_error(F.lit("an entry needs more than 63 bits")).cast("array<long>")).otherwise(code)
    given = vectors.where(finite & (F.size(vec) > 0))
    codes = stage(given.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), code.alias("x")), "codes")
    size = codes.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return spark.createDataFrame([], _RESULT)
    codes = codes.where(F.size("x") == size)
    whole = spectrum(codes, size, block)
    n, sums = whole.n, whole.sums + ORIGIN * whole.n
    basis = np.linalg.qr(whole.vectors[:, ::-1])[0]
    ritz = sum_arrays(codes.mapInArrow(_projected(size, n, sums, spark.sparkContext.broadcast(basis)), "data binary")).reshape(size, size) / n
    values, turn = np.linalg.eigh(ritz)
    values, turn = values[::-1], basis @ turn[:, ::-1]
    k = int(min(components, (values > RANK * max(values[0], 0)).sum()))
    if k == 0:
        return spark.createDataFrame([], _RESULT)
    shared = spark.sparkContext.broadcast(turn[:, :k] / np.sqrt(values[:k]))
    rows = stage(codes.mapInArrow(_whitened(size, n, sums, shared), "vec_id long, deviation long, whitened array<double>"), "whitened")
    moments = sum_arrays(rows.select("whitened").mapInArrow(_moments(k), "data binary")).reshape(k + 1, k) / n
    error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())
    explained = F.get(F.lit((values[:k] / values.sum()).tolist()), F.col("i"))
    out = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return out.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error")
    )
