"""Whitening of embeddings: exact sums and centred scatters of partitions, merged pairwise, then one small eigenproblem.

An entry c becomes the whole number x = floor(1024 c) + 100000.  A partition keeps its count, the exact sums of x (so its
mean) and the scatter around that mean; two of them merge by Chan's formula, in which only the difference of the means
enters, so the large offset of x never cancels.  ``treeReduce`` merges partitions on executors, a few at a time; the driver
gets one d x d matrix.  The components are those of ``eigh``; a second pass measures the covariance of what came out.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import reach_workers

SCALE, OFFSET = 1024, 100_000
#: Scaled entries beyond this count as this.
LARGEST = 1 << 62
#: Components given for each vector.
COMPONENTS = 8
#: Partial results that one merging task, or the driver at the end, reads at most (some more where they don't divide evenly).
FAN_IN = 8


@dataclass(frozen=True)
class Moments:
    """``n`` rows, their ``sums`` (Python integers of whole numbers, else floats) and the scatter around their mean."""

    n: int
    sums: np.ndarray
    scatter: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / self.n).astype(float)

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of the rows of a matrix of int64 or of float64."""
        n = len(x)
        if x.dtype == np.int64:
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = high.astype(object) * (1 << 32) + low.astype(object)
            whole = np.array([s // n for s in sums], np.int64) if n else np.zeros(x.shape[1], np.int64)
            part = np.array([(s % n) / n for s in sums]) if n else np.zeros(x.shape[1])
            centred = (x - whole).astype(float) - part
        else:
            sums = x.sum(axis=0)
            centred = x - (sums / n if n else 0.0)
        return Moments(n, sums, centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        # whole numbers up to the division, so the difference of the means is rounded once
        delta = ((other.sums * self.n - self.sums * other.n) / (self.n * other.n)).astype(float)
        return Moments(n, self.sums + other.sums, self.scatter + other.scatter + np.outer(delta, delta) * (self.n / n * other.n))

    def covariance(self) -> np.ndarray:
        return self.scatter / self.n


@dataclass(frozen=True)
class Whitener:
    """``vectors`` has a column for each component of the fitted rows, ``values`` their variances, ``total`` the trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    total: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S of rows of whole numbers, exact: int64 where that holds it, else Python integers."""
        most = max((abs(self.n * int(b) - int(s)) for b, s in zip([*x.max(axis=0), *x.min(axis=0)], [*self.sums] * 2)), default=0) if len(x) else 0
        wide = max(most, self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))), *(abs(int(s)) for s in self.sums), 0)
        if wide < 1 << 62:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        """Rows projected on the components over their standard deviations; NaN where a component has no variance."""
        centred = (deviations / self.n).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return centred @ self.vectors * scale


def whole(c: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of finite entries."""
    return np.clip(np.floor(SCALE * c), -float(LARGEST), float(LARGEST)).astype(np.int64) + OFFSET


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return whole(np.asarray(column.flatten(), dtype=float).reshape(-1, size))


def usable(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vector is there, has finite entries alone and the commonest length (of equally common ones the largest);
    that length, 0 without rows."""
    fit = F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = df.where(fit & (F.size(vector) > 0))
    size = F.size(vector).alias("d")
    first = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (rows.where(F.size(vector) == first["d"]), first["d"]) if first else (rows, 0)


def moments(rows: DataFrame, vector: str, size: int, whitener: Whitener | None = None) -> Moments:
    """Merged moments of the whole numbers of all rows, or of what a whitener makes of them."""
    shared = rows.sparkSession.sparkContext.broadcast(whitener)  # d x 8 numbers

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch.column(0), size), shared.value
            one = Moments.of(x if w is None else w.whiten(w.deviations(x))[:, w.values > 0])
            own = one if own is None else own.merge(one)
        if own is not None:
            numbers = [str(int(s)) if w is None else float(s).hex() for s in own.sums]
            yield pa.RecordBatch.from_arrays([pa.array([own.n]), pa.array([numbers], pa.list_(pa.string())), pa.array([own.scatter.tobytes()], pa.binary())], ["n", "sums", "scatter"])

    exact = whitener is None

    def read(row) -> Moments:
        sums = np.array([int(s) for s in row["sums"]], object) if exact else np.array([float.fromhex(s) for s in row["sums"]])
        return Moments(row["n"], sums, np.frombuffer(row["scatter"]).reshape(len(sums), len(sums)))

    parts = rows.select(vector).mapInArrow(local, "n long, sums array<string>, scatter binary").rdd.map(read)
    depth = max(2, math.ceil(math.log(max(parts.getNumPartitions(), 2), FAN_IN)))
    return parts.treeReduce(Moments.merge, depth)


def fit(rows: DataFrame, vector: str, size: int, components: int = COMPONENTS) -> Whitener | None:
    """The first components of rows of one length; None without rows.

    Each has its largest entry positive.  Components whose variance is zero but for rounding have the variance 0.
    """
    reach_workers(rows.sparkSession)
    if not size:
        return None
    found = moments(rows, vector, size)
    values, vectors = np.linalg.eigh(found.covariance())
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    total = float(np.trace(found.covariance()))
    return Whitener(found.n, found.sums, vectors, np.where(values > size * np.finfo(float).eps * max(total, 0.0), values, 0.0), total)


def identity_error(rows: DataFrame, vector: str, whitener: Whitener) -> float | None:
    """How far the covariance of the whitened rows is from the identity at most; None where no component has variance."""
    if not (whitener.values > 0).any():
        return None
    found = moments(rows, vector, len(whitener.vectors), whitener).covariance()
    return float(np.abs(found - np.eye(len(found))).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each usable vector and component.

    Rows whose vector is null, empty, holds a null or a non-finite entry, or has another length than most vectors have drop
    out.  Keys may be null or repeat; equal rows give equal results.  ``deviation`` is the exact sum over dimensions of
    (n x - S)^2 as decimal(38, 0), null where that has no room.  A component without variance has a null ``whitened``, and
    without any variance ``explained`` is null too, as is ``identity_error`` where no component has any.  Vectors of fewer
    than ``components`` dimensions have as many components as dimensions.  An empty table gives no rows; other columns do
    not pass.  The rows are read four times: lengths, moments, check, result.
    """
    spark = df.sparkSession
    rows, size = usable(df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")), "vector")
    model = fit(rows, "vector", size, components)
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    error = identity_error(rows, "vector", model)
    shared = spark.sparkContext.broadcast((model, error))

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, e = shared.value
        k = w.vectors.shape[1]
        wide = pa.decimal128(38, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = w.deviations(_matrix(batch.column(1), size))
            most = int(np.abs(y).max(initial=0))
            if y.dtype == np.int64 and size * most * most < 1 << 63:
                sums = pa.array((y * y).sum(axis=1)).cast(wide)
            else:
                exact = [sum(int(v) * int(v) for v in row) for row in y]
                sums = pa.array([decimal.Decimal(s) if s < 10**38 else None for s in exact], wide)
            n = batch.num_rows
            z = w.whiten(y).ravel()
            at = pa.array(np.repeat(np.arange(n), k))
            share = np.tile(w.values / w.total if w.total > 0 else np.full(k, np.nan), n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, w.n)), sums.take(at),
                    pa.array(z, pa.float64(), mask=np.isnan(z)), pa.array(share, pa.float64(), mask=np.isnan(share)), pa.array([e] * (n * k), pa.float64()),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("key", "vector").mapInArrow(out, schema).withColumnRenamed("key", key)


def as_long(deviation: str) -> Column:
    """A decimal as a long, null where it does not fit."""
    return F.expr(f"try_cast({deviation} AS BIGINT)")
