"""Whitening of embeddings by shifted CholeskyQR.

Each component c becomes the integer floor(``scale`` * c). The fit list holds each distinct vector once;
its number n and sums S are exact. A, the fit list less its means, is never held: each pass reads the
vectors, centres them and applies the triangular factors found so far, so memory is one Arrow batch and one
matrix of the vectors' width a task.

1. G = A'A; R1 is the Cholesky factor of G + shift * I, with the shift that keeps G positive definite whatever the rounding.
2. Q1 = A / R1 by a triangular solve; G = Q1'Q1; R2 is its factor. Q2 = Q1 / R2; G = Q2'Q2; R3 is its factor.
   A factor that breaks down (columns that depend on each other) takes the shift again, and passes go on until Q'Q is the
   identity to rounding, or does not come nearer to it.
3. R = R3 R2 R1 has A'A = R'R, so with the singular values s and right vectors v of R, v are the components of the
   covariance and s * s / n their eigenvalues.

A task adds its rows into one Gram matrix; the matrices of tasks are summed in ``SUMS`` tasks, which
read them as a stream, and those few sums on the driver: it gets ``SUMS`` matrices at any size of the table.

Rows whose vector is null or holds null or non-finite components take no part, nor do vectors of another length
than most have (of equally frequent lengths the greater counts). Rows without an id, or with a repeated one, are rows
of their own; equal vectors count once in the fit. Other columns are left out, whatever their names. Components beyond a
64-bit integer count as its limits. ``deviation`` is null where it passes a 64-bit integer. A component
without variance (fewer distinct vectors than components, or constant ones) has a null ``whitened`` and an
``explained`` of 0, and ``identity_error`` leaves it out. An empty table gives no rows; texts play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.session import materialise

SCALE, TOP, SUMS, PASSES = 256.0, 4, 16, 6
#: Eigenvalues below this share of the trace count as none.
FLAT = 1e-13


def integers(df: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id, x``: the rows that take part, their components as integers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    rows = rows.where(F.col("c").isNotNull() & F.forall("c", finite))
    # A floor beyond 64 bits becomes the nearest limit.
    rows = rows.select("vec_id", F.transform("c", lambda c: F.floor(c * scale)).alias("x"))
    size = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("x") == (size[0] if size else 0))


def matrix(vectors: pa.Array) -> np.ndarray:
    """A batch of vectors of one length as rows of integers."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _summed(df: DataFrame, part: Callable[[np.ndarray], np.ndarray], zero: np.ndarray, kind: str) -> np.ndarray:
    """The sum of ``part`` over all batches of ``x``: one array a task, then ``SUMS`` arrays to the driver."""

    def pack(total: np.ndarray) -> pa.RecordBatch:
        values = [str(v) for v in total.ravel()] if kind == "string" else total.ravel()
        return pa.RecordBatch.from_arrays([pa.array([list(values)], pa.list_(pa.string() if kind == "string" else pa.float64()))], ["v"])

    def unpack(values: list) -> np.ndarray:
        return np.array([int(v) for v in values] if kind == "string" else values, zero.dtype).reshape(zero.shape)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = zero.copy(), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + part(matrix(batch["x"])), True
        if seen:
            yield pack(total)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = zero.copy(), False
        for batch in batches:
            for values in batch["v"]:
                total, seen = total + unpack(values.as_py()), True
        if seen:
            yield pack(total)

    schema = f"v array<{kind}>"
    parts = df.select("x").mapInArrow(first, schema).withColumn("at", F.pmod(F.spark_partition_id(), F.lit(SUMS)))
    sums = parts.repartitionById(SUMS, F.col("at")).select("v").mapInArrow(second, schema).collect()  # at most SUMS rows
    total = zero.copy()
    for row in sums:
        total = total + unpack(row[0])
    return total


def exact_sums(fit: DataFrame, width: int) -> list[int]:
    """n and the sum of each component, as exact integers of any size."""

    def part(x: np.ndarray) -> np.ndarray:
        safe = not x.size or max(abs(int(x.min())), abs(int(x.max()))) < 2**62 // len(x)
        sums = x.sum(axis=0) if safe else [sum(column) for column in x.T.tolist()]
        return np.array([len(x), *map(int, sums)], object)

    return _summed(fit, part, np.array([0] * (width + 1), object), "string").tolist()


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x less the means; integers are subtracted first, so that large equal parts cancel exactly."""
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    if all(abs(w) < 2**62 for w in whole) and (not x.size or max(abs(int(x.min())), abs(int(x.max()))) < 2**62):
        return (x - np.array(whole, "int64")) - rest
    return (x.astype(object) - np.array(whole, object)).astype("float64") - rest


@dataclass
class Model:
    n: int
    sums: list[int]
    components: np.ndarray  # a column each
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None = None

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened rows, NaN in components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varies, rows @ self.components / np.sqrt(self.eigenvalues), np.nan)

    @property
    def varies(self) -> np.ndarray:
        return self.eigenvalues > FLAT * self.trace

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S) ** 2 of each row, exact; None beyond 64 bits."""
        most = max((abs(int(v)) for v in (x.min(), x.max())), default=0) if x.size else 0
        bound = self.n * most + max(map(abs, self.sums), default=0)
        if bound * bound * max(1, x.shape[1]) < 2**63:
            y = x * self.n - np.array(self.sums, "int64")
            return np.einsum("ij,ij->i", y, y).tolist()
        found = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d < 2**63 else None for d in found]


def _cholesky(gram: np.ndarray, rows: int) -> np.ndarray:
    """The upper factor of a Gram matrix, shifted if it is not positive definite in rounded numbers."""
    try:
        return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        return _shifted(gram, rows)


def _shifted(gram: np.ndarray, rows: int) -> np.ndarray:
    """The upper factor of gram + shift * I; the shift grows until the factor exists."""
    width, unit = len(gram), np.finfo("float64").eps / 2
    size = float(np.linalg.norm(gram, 2)) or 1.0
    # The bound of shifted CholeskyQR with blocked sums: their error does not grow with the rows as such.
    shift = 11 * (min(rows, 10_000) * width + width * (width + 1)) * unit * size
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift *= 10


def fitted(fit: DataFrame, width: int, top: int = TOP) -> Model | None:
    """Components of the distinct vectors ``x``; None if there are none."""
    n, *sums = exact_sums(fit, width)
    if not n or not width:
        return None
    factors: list[np.ndarray] = []
    whole = np.eye(width)
    best = None
    for number in range(PASSES):

        def gram(x: np.ndarray) -> np.ndarray:
            rows = centred(x, sums, n)
            for factor in factors:
                rows = solved(rows, factor)
            return rows.T @ rows

        found = _summed(fit, gram, np.zeros((width, width)), "double")
        found = (found + found.T) / 2
        if number == 0 and not found.any():
            break  # all vectors are one
        factor = _shifted(found, n) if number == 0 else _cholesky(found, n)
        off = np.abs(found - np.eye(width)).max() if number else np.inf
        factors, whole = [*factors, factor], factor @ whole
        if number >= 2 and (off < 1e-12 * width or (best is not None and off > best / 2)):
            break
        best = off
    values, vectors = np.zeros(width), np.eye(width)
    if factors:
        _, singular, right = np.linalg.svd(whole)
        values, vectors = singular**2 / n, right.T
    model = Model(n, sums, vectors[:, :top], values[:top], float(values.sum()))
    if not factors:
        return model
    keep = np.flatnonzero(model.varies)

    def covariance(x: np.ndarray) -> np.ndarray:
        rows = model.project(centred(x, sums, n))[:, keep]
        return np.vstack([rows.T @ rows, rows.sum(axis=0)])

    found = _summed(fit, covariance, np.zeros((len(keep) + 1, len(keep))), "double")
    mean = found[-1] / n
    model.identity_error = float(np.abs(found[:-1] / n - np.outer(mean, mean) - np.eye(len(keep))).max()) if len(keep) else None
    return model


def whiten(df: DataFrame, top: int = TOP, scale: float = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    rows = materialise(integers(df, scale))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    one = rows.select(F.size("x")).first()
    fit = materialise(rows.select("x").distinct())
    model = fitted(fit, one[0], top) if one else None
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    explained = [float(e / model.trace) if v else 0.0 for e, v in zip(model.eigenvalues, model.varies, strict=True)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(explained)
        for batch in batches:
            x = matrix(batch["x"])
            white = model.project(centred(x, model.sums, model.n)).ravel()
            each = np.repeat(np.arange(len(x)), many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype="int32"), len(x))),
                    pa.array(np.full(len(each), model.n, "int64")),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array([model.identity_error] * len(each), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, schema)
