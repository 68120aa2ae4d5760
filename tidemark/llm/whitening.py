"""Whitening of vectors by cyclic Jacobi rotations.

One pass over the vectors gives the fit: each task sends its count, exact sums and the scatter about its own mean (merged
batch by batch), and Spark adds these up about the common mean. The driver, which holds one width x width matrix, turns
away every off-diagonal entry in turn, sweep by sweep, until all have vanished; rotations leave the error of a small
eigenvalue small against that eigenvalue's own size in well scaled matrices. A second pass takes the covariance of what
the whitening gives, a third one writes it.

Defined results: rows with a null vector, or with null, NaN or infinite entries, are not returned; shorter vectors count
as filled up with zeros to the longest one's length, which may be 4,096 (ValueError beyond); entries beyond 2^40 in size
count as that; components whose eigenvalue is zero to rounding have no whitened value (null) and are left out of
identity_error; where the trace is zero explained is null; a deviation past the range of a long is null. Repeated rows
and ids count each time, null ids stay; an empty table gives an empty table; extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import dropped, settled, workers_find_library
from .vectors import whole_vectors, with_doubles

#: Longest vector, largest entry, what stands for an entry of zero, and the rows of which exact sums are taken at once.
MOST_WIDTH, LARGEST, ZERO, ROWS_AT_ONCE = 4096, 2.0**40, 1_000_000, 4096


def _integers(vectors: np.ndarray, width: int) -> np.ndarray:
    out = np.full((len(vectors), width), ZERO, np.int64)
    out[:, : vectors.shape[1]] += np.floor(64 * np.clip(vectors, -LARGEST, LARGEST)).astype(np.int64)
    return out


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (as columns) of a symmetric matrix."""
    a, turned = matrix.astype(np.float64).copy(), np.eye(len(matrix))
    for _ in range(sweeps):
        rotations = 0
        for p in range(len(a) - 1):
            for q in range(p + 1, len(a)):
                # An entry has vanished when it no longer counts beside its two diagonal entries.
                if abs(a[p, q]) <= 1e-17 * np.sqrt(abs(a[p, p])) * np.sqrt(abs(a[q, q])) or a[p, q] == 0:
                    continue
                rotations += 1
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = np.copysign(1.0, theta) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                shift = t * a[p, q]
                low, high = a[p, p] - shift, a[q, q] + shift
                for m in (a, turned):
                    m[:, [p, q]] = np.stack([c * m[:, p] - s * m[:, q], s * m[:, p] + c * m[:, q]], axis=1)
                a[[p, q]] = a[:, [p, q]].T
                a[p, p], a[q, q], a[p, q], a[q, p] = low, high, 0.0, 0.0
        if not rotations:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], turned[:, order]


class _Moments:
    """Count, exact sums and scatter about the own mean."""

    def __init__(self, width: int = 0):
        self.n, self.total, self.scatter = 0, [0] * width, np.zeros((width, width))

    def widen(self, width: int) -> None:
        more = width - len(self.total)
        if more > 0:
            self.total += [ZERO * self.n] * more
            self.scatter = np.pad(self.scatter, (0, more))

    def add(self, n: int, total: list[int], scatter: np.ndarray) -> None:
        self.widen(len(total))
        if self.n:
            apart = np.array([(b * self.n - a * n) / (self.n * n) for a, b in zip(self.total, total)])  # exact until divided
            scatter = scatter + np.outer(apart, apart) * (self.n * n / (self.n + n))
        self.n, self.total, self.scatter = self.n + n, [a + b for a, b in zip(self.total, total)], self.scatter + scatter

    def add_rows(self, x: np.ndarray) -> None:
        total = x.sum(axis=0)
        apart = (x * len(x) - total) / len(x)
        self.add(len(x), total.tolist(), apart.T @ apart)


def _fit(whole: DataFrame) -> tuple[int, list[int], np.ndarray] | None:
    """Rows, sums and covariance. What tasks send is a matrix each; it is added up in tasks, by rows of the matrix."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Moments()
        for batch in batches:
            _, vectors = whole_vectors(batch)
            if vectors.shape[1] > MOST_WIDTH:
                raise ValueError(f"a vector of {vectors.shape[1]} entries; the most is {MOST_WIDTH}")
            for at in range(0, len(vectors), ROWS_AT_ONCE):
                part = vectors[at : at + ROWS_AT_ONCE]
                own.widen(part.shape[1])
                own.add_rows(_integers(part, len(own.total)))
        if own.n:
            yield pa.RecordBatch.from_arrays([pa.array([own.n], pa.int64()), pa.array([own.total], pa.list_(pa.int64())), pa.array([own.scatter.ravel()], pa.list_(pa.float64()))], names=["n", "total", "scatter"])

    sent = settled(whole.mapInArrow(moments, "n long, total array<long>, scatter array<double>"), "moments")
    n, width = sent.agg(F.sum("n"), F.max(F.size("total"))).first()
    if n is None:
        dropped(sent)
        return None
    sums = sent.select("n", F.size("total").alias("own"), F.posexplode(F.concat("total", F.array_repeat(F.col("n") * ZERO, F.lit(width) - F.size("total")))).alias("place", "total"))
    total = [int(r["total"]) for r in sums.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("place").collect()]

    def about_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros((width, width))
        for batch in batches:
            for count, own, scatter in zip(*(c.to_pylist() for c in batch.columns)):
                k = len(own)
                apart = np.array([(a * n - b * count) / (count * n) for a, b in zip(own + [ZERO * count] * (width - k), total)])
                added[:k, :k] += np.array(scatter).reshape(k, k)
                added += np.outer(apart, apart) * count
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(added), pa.list_(pa.float64()))], names=["row", "entries"])

    scatter = _added_up(sent.mapInArrow(about_common, "row int, entries array<double>"), width)
    dropped(sent)
    return n, total, scatter / n


def _added_up(matrix_rows: DataFrame, width: int) -> np.ndarray:
    """The sum of matrices that tasks sent row by row: width x width numbers reach the driver."""
    out = np.zeros((width, width))
    for r in matrix_rows.select("row", F.posexplode("entries").alias("column", "x")).groupBy("row", "column").agg(F.sum("x").alias("x")).collect():
        out[r["row"], r["column"]] = r["x"]
    return (out + out.T) / 2


def _identity_error(whole: DataFrame, centre: np.ndarray, project: np.ndarray, n: int) -> float:
    """The largest absolute entry of whitened's covariance minus the identity, over all rows."""
    width = project.shape[1]

    def scatters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros((width + 1, width + 1))
        for batch in batches:
            z = (_integers(whole_vectors(batch)[1], len(centre)) - centre) @ project
            z = np.column_stack([z, np.ones(len(z))])  # the last row gives sums: the mean, zero but for rounding, is taken off below
            added += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array(list(added), pa.list_(pa.float64()))], names=["row", "entries"])

    found = _added_up(whole.mapInArrow(scatters, "row int, entries array<double>"), width + 1) / n
    covariance = found[:width, :width] - np.outer(found[width, :width], found[width, :width])
    return float(np.abs(covariance - np.eye(width)).max(initial=0))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 32) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each vector and each of its first components, `most` at most."""
    workers_find_library(rows.sparkSession)
    whole = with_doubles(rows, vector, F.col(key).alias("vec_id"))
    schema = T.StructType([whole.schema["vec_id"], *(T.StructField(name, kind) for name, kind in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType()),
    ))])
    fit = _fit(whole)
    if fit is None or not fit[1]:
        return rows.sparkSession.createDataFrame([], schema)
    n, total, covariance = fit
    values, axes = jacobi(covariance)
    trace = float(np.trace(covariance))
    used = min(most, len(values))
    sound = values[:used] > len(values) * np.finfo(float).eps * max(values[0], 0)
    centre = np.array([t / n for t in total])
    project = axes[:, :used][:, sound] / np.sqrt(values[:used][sound])
    error = _identity_error(whole, centre, project, n)
    explained = [float(v) / trace if trace > 0 else None for v in values[:used]]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, vectors = whole_vectors(batch)
            x = _integers(vectors, len(centre))
            z = np.full((len(x), used), np.nan)
            z[:, sound] = (x - centre) @ project
            deviation = _deviations(x, n, total)
            ids = batch.column(0).filter(pa.array(good)).take(pa.array(np.repeat(np.arange(len(x)), used)))
            rows_out = len(x) * used
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, used + 1), len(x)), pa.int32()), pa.array(np.full(rows_out, n)), pa.array([d for d in deviation for _ in range(used)], pa.int64()),
                pa.array(z.ravel(), pa.float64(), from_pandas=True), pa.array(explained * len(x), pa.float64()), pa.array(np.full(rows_out, error)),
            ], names=schema.names)

    return whole.mapInArrow(written, schema)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exact, for each row."""
    largest = max((max(abs(n * int(lo) - t), abs(n * int(hi) - t)) for lo, hi, t in zip(x.min(axis=0), x.max(axis=0), total)), default=0) if len(x) else 0
    if largest * largest * x.shape[1] < 1 << 62 and (abs(x).max(initial=0) * n) < 1 << 62:
        return ((n * x - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(total, object)) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in exact]
