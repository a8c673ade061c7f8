"""Dimension reduction for wide vectors (M15, M16, A12): a randomised range finder.

No d x d matrix exists anywhere.  A random block of ``components + oversample`` directions is turned towards the leading
components by ``power`` passes over the centred rows (each adds up ``x (x . w)``, a d x l block, and the driver makes it
orthonormal).  A last pass projects the rows on the block and reduces the tall, narrow result to its l x l triangle by QR: in
every task block by block, then in a tree of tasks.  The singular values of the triangle are those of the projected
rows, without squaring them, and its right factor turns the block into the components.

With as many directions as dimensions the result is exact up to rounding.  Rows without a vector take no part; a row with a
null or NaN component, or of another length than the first, is an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 16   # partial results that one task puts together
LAST = 4   # partial results that the driver puts together
ROWS = 1024


def _chunks(batches: Iterator[pa.RecordBatch], at: int, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            lists = part.column(at)
            if part.num_rows and set(pa.compute.list_value_length(lists).to_pylist()) != {dim}:
                raise ValueError("vectors of different dimension")
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            if not np.isfinite(x).all():
                raise ValueError("a vector has a component that is no number")
            yield part, x


def _blob(x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], ["blob"])


def reduced(rows: DataFrame, vec: str, dim: int, width: int, start: np.ndarray, step: Callable, merge: Callable) -> np.ndarray:
    """``step`` folds blocks of rows into a matrix of ``width`` columns in every task; ``merge`` puts two of them together, in a tree
    of tasks and at last here."""
    tasks = rows.rdd.getNumPartitions()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start
        for _, x in _chunks(batches, 0, dim):
            total = step(total, x)
        yield _blob(total)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for blob in b.column(0).to_pylist():
                own = np.frombuffer(blob).reshape(-1, width)
                total = own if total is None else merge(total, own)
        if total is not None:
            yield _blob(total)

    parts = rows.select(vec).mapInArrow(fold, "blob binary")
    while tasks > LAST:
        tasks = max(1, math.ceil(tasks / FAN))
        parts = parts.withColumn("g", F.spark_partition_id() % tasks).repartition(tasks, "g").select("blob").mapInArrow(join, "blob binary")
    total = start
    for r in parts.collect():
        total = merge(total, np.frombuffer(r.blob).reshape(-1, width))
    return total


@dataclass
class WideReduction:
    mean: np.ndarray
    axes: np.ndarray          # one row for each kept component
    ratios: list[float]       # share of the total variance
    total_variance: float
    vec_col: str

    @property
    def n(self) -> int:
        return len(self.axes)

    def transform(self, df: DataFrame, out_col: str = "reduced") -> DataFrame:
        """``df`` with the components of its vectors (null for a null vector)."""
        shared = df.sparkSession.sparkContext.broadcast((self.mean, self.axes))
        own = df.select(*df.columns, F.col(self.vec_col).cast("array<double>").alias(out_col))
        at, dim, k = len(df.columns), len(self.mean), self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mean, axes = shared.value
            for b in batches:
                some = b.filter(b.column(at).is_valid())
                none = b.filter(b.column(at).is_null())
                for part, x in _chunks(iter([some]), at, dim):
                    y = (x - mean) @ axes.T
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), pa.array(y.ravel()))
                    yield pa.RecordBatch.from_arrays([*part.columns[:at], lists], part.schema.names)
                if none.num_rows:
                    yield none

        return own.mapInArrow(run, own.schema)


def fit(df: DataFrame, vec_col: str, components: int, variance: float | None = None, oversample: int = 10, power: int = 3,
        seed: int = 17) -> WideReduction:
    """The leading ``components`` (with ``variance``: the fewest of them whose share of the variance is greater)."""
    rows = df.select(F.col(vec_col).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    first = rows.select(F.size("v")).first()
    if first is None:
        raise ValueError("no vectors")
    dim = first[0]
    ones = reduced(rows, "v", dim, dim + 1, np.zeros((1, dim + 1)), lambda t, x: t + np.append(x.sum(0), len(x))[None, :], lambda a, b: a + b)[0]
    n, mean = ones[-1], ones[:-1] / ones[-1]
    width = min(dim, components + oversample)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
    sc = df.sparkSession.sparkContext
    for _ in range(power if width < dim else 0):
        sent = sc.broadcast((mean, block))

        def turn(t: np.ndarray, x: np.ndarray) -> np.ndarray:
            m, w = sent.value
            z = x - m
            return t + z.T @ (z @ w)

        block = np.linalg.qr(reduced(rows, "v", dim, width, np.zeros((dim, width)), turn, lambda a, b: a + b))[0]
        sent.unpersist()
    sent = sc.broadcast((mean, block))

    def triangle(t: np.ndarray, x: np.ndarray) -> np.ndarray:
        m, w = sent.value
        z = x - m
        r, spread = t[:-1], t[-1:].copy()
        spread[0, 0] += (z * z).sum()  # the last row holds the total
        return np.concatenate((np.linalg.qr(np.concatenate((r, z @ w)), mode="r"), spread))

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.concatenate((np.linalg.qr(np.concatenate((a[:-1], b[:-1])), mode="r"), a[-1:] + b[-1:]))

    found = reduced(rows, "v", dim, width, np.zeros((1, width)), triangle, both)
    total = found[-1, 0] / max(1.0, n - 1)
    _, s, right = np.linalg.svd(found[:-1], full_matrices=False) if len(found) > 1 else (None, np.zeros(0), np.zeros((0, width)))
    k = min(components, len(s))
    ratios = (s ** 2 / max(1.0, n - 1) / total if total > 0 else s * 0.0)[:k].tolist()
    if variance is not None:
        share = np.cumsum(ratios)
        k = min(k, int(np.searchsorted(share, variance, side="right")) + 1)
    return WideReduction(mean, (block @ right[:k].T).T, ratios[:k], float(total), vec_col)
