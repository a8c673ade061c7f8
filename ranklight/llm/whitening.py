"""Whitening of embeddings by their leading principal components, found by a block Jacobi-Davidson method.

The covariance is never formed.  Vectors become whole numbers ``x = floor(64 c) + 1000000``, packed in blocks; a product with
the covariance is one Spark job over the blocks, ``sum of z (z . w)`` with ``z = (n x - S) / n`` taken from exact integers, for all
columns ``w`` at hand at once.  The driver holds a few dozen vectors of the dimension, never rows.

1. Rayleigh-Ritz over a subspace gives approximate components and their residuals.
2. Leading components whose residual has reached double precision are locked and projected out from then on.
3. For the next ones, the correction equation ``(I - QQ')(V - e I)(I - QQ') t = -r`` (``Q``: the locked ones and the component
   itself) is solved roughly by MINRES, one product for a step of all of them.
4. The corrections extend the subspace; it restarts from its best vectors when it is large.
5. When all are locked, their residuals are taken anew from a product, and the search goes on if one is too large.

Defined cases.  Rows whose vector is null or holds a null or non-finite entry take no part.  Entries a vector has less than
the longest one count as 0.  Entries beyond ``2**45`` count as that.  Repeated rows, and rows with null ids, are rows of their own.
Components without variance (an eigenvalue of at most ``NOTHING`` times the largest) are left out, as nothing can be divided by
them: an empty table, a single row or equal rows give no result rows.  A deviation too large for a long is null.  Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import Shared, pack, tidied, unpack
from ranklight.sources.scratch import materialize

COMPONENTS = 32
BLOCK_BYTES = 8 << 20      # of a block as double numbers
CORRECTIONS = 16           # components corrected at a time
INNER_STEPS = 6            # of MINRES
OUTER_STEPS = 300
TREE = 64                  # partial sums the driver adds up itself
NOTHING = 1e-12
LARGEST = 1 << 45
OFFSET = 1_000_000
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _packed(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Blocks of whole numbers ``floor(64 c)`` in the smallest type that holds them."""
    rows = max(1, BLOCK_BYTES // (8 * dim))
    for b in batches:
        for at in range(0, b.num_rows, rows):
            own = b.slice(at, rows)
            lists = own.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = np.floor(64.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            flat = np.clip(flat, -LARGEST, LARGEST).astype(np.int64)
            matrix = np.zeros((own.num_rows, dim), np.int64)
            matrix[np.arange(dim) < sizes[:, None]] = flat
            small = next(t for t in (np.int8, np.int16, np.int32, np.int64) if abs(matrix).max(initial=0) <= np.iinfo(t).max)
            blob = pack({"x": pa.array(matrix.astype(small).reshape(-1))}, level=1)
            yield pa.RecordBatch.from_arrays([pa.array([pack({"id": own.column(0)}, level=1)], pa.binary()), pa.array([blob], pa.binary())],
                                             ["ids", "x"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[bytes, np.ndarray]]:
    for b in batches:
        for ids, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield ids, unpack([x]).column(0).to_numpy().reshape(-1, dim)


class Centred:
    """The packed vectors with their count and sums; products run over them as Spark jobs."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding"):
        vec = F.col("v")
        own = vectors.select(vectors[f"`{id_col}`"].cast("long").alias("i"), vectors[f"`{vec_col}`"].cast("array<double>").alias("v"))
        fit = F.forall(vec, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
        own = own.filter(vec.isNotNull() & fit)
        self.spark = vectors.sparkSession
        self.dim = own.agg(F.max(F.size("v"))).first()[0] or 0
        if not self.dim:
            self.n = 0
            return
        dim = self.dim
        self.blocks = materialize(own.mapInArrow(tidied(lambda b: _packed(b, dim)), "ids binary, x binary"), "whitening-blocks")
        # sums of small numbers; the offset is added once, exactly
        low = self._totals(lambda x: np.concatenate(([len(x)], x.sum(0, dtype=np.int64), [-int(abs(x.astype(np.int64)).max())])), np.int64)
        self.n = int(low[0][0]) if low else 0
        if not self.n:
            return
        self.sums = [int(v) for v in low[0][1:-1]]
        self.largest = int(low[1])
        self.trace = self._spread()

    def _totals(self, of: Callable[[np.ndarray], np.ndarray], kind: type):
        """Per-task sums of whole numbers, added as Python integers (a long could overflow), and the largest entry."""
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, least = None, 0
            for _, x in _blocks(batches, dim):
                own = [int(v) for v in of(x)]
                least = min(least, own[-1])
                total = own if total is None else [a + b for a, b in zip(total, own)]
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, total))]), pa.array([str(-least)])], ["s", "m"])

        rows = self.blocks.mapInArrow(tidied(run), "s string, m string").selectExpr(
            "posexplode(split(s, ',')) AS (i, v)", "m").groupBy("i").agg(
            F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v"), F.max(F.col("m").cast("long")).alias("m")).collect()
        by = {r.i: int(r.v) for r in rows}
        return ([by[i] for i in range(len(by))], max(r.m for r in rows)) if rows else None

    @property
    def exact(self) -> bool:
        """Whether ``n x - S`` and the sum of its squares over a row fit a long."""
        reach = 2 * self.n * self.largest
        return reach * reach * self.dim < 1 << 63

    def _centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """Of a block of whole numbers the numerators ``n x - S``, exact (Python integers where a long is too small)."""
        n, sums = self.n, self.sums
        if 2 * n * self.largest < 1 << 63:
            s = np.array(sums, np.int64)
            return lambda x: x.astype(np.int64) * n - s
        big = np.array(sums, object)
        return lambda x: x.astype(object) * n - big

    def rows_of(self) -> Callable[[np.ndarray], np.ndarray]:
        n, centre = self.n, self._centre()
        return lambda x: centre(x).astype(np.float64) / n

    def _sum(self, of: Callable, shape: tuple) -> np.ndarray:
        """The sum of ``of(rows)`` over all blocks: in each task first, then in groups of tasks, then here."""
        dim, rows = self.dim, self.rows_of()
        load = of.load if isinstance(of, Shared) else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fn = load() if load else of
            total = 0.0
            for _, x in _blocks(batches, dim):
                total = total + fn(rows(x))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], ["s"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for b in batches:
                for s in b.column(0).to_pylist():
                    total = total + np.frombuffer(s)
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

        parts = self.blocks.mapInArrow(run, "s binary")
        if (tasks := self._tasks()) > TREE:
            parts = parts.withColumn("g", F.spark_partition_id() % int(tasks ** 0.5)).repartition(
                int(tasks ** 0.5), "g").select("s").mapInArrow(add, "s binary")
        total = np.zeros(shape)
        for r in parts.collect():
            total += np.frombuffer(r.s).reshape(shape)
        return total

    def _tasks(self) -> int:
        if not hasattr(self, "_n_tasks"):
            self._n_tasks = self.blocks.select(F.spark_partition_id().alias("p")).distinct().count()
        return self._n_tasks

    def times(self, w: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``w``."""
        sent = Shared(self.spark, _Product(w))
        out = self._sum(sent, w.shape) / self.n
        sent.sent.unpersist()
        return out

    def _spread(self) -> int:
        """The sum of all squares of ``n x - S``, exact."""
        dim, centre, exact = self.dim, self._centre(), self.exact

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for _, x in _blocks(batches, dim):
                total += sum(int(v) for v in _deviations(centre(x), exact))
            yield pa.RecordBatch.from_arrays([pa.array([str(total)])], ["s"])

        # at most 60 digits, so in two halves of at most 30 for the decimal sums
        halves = self.blocks.mapInArrow(tidied(run), "s string").selectExpr("lpad(s, 60, '0') AS s").agg(
            F.sum(F.substring("s", 1, 30).cast("decimal(38,0)")).cast("string"), F.sum(F.substring("s", 31, 30).cast("decimal(38,0)")).cast("string"))
        high, low = halves.first()
        return int(high) * 10 ** 30 + int(low)


def _deviations(d: np.ndarray, exact: bool) -> np.ndarray:
    return np.einsum("ij,ij->i", d, d) if exact else (d.astype(object) ** 2).sum(1)


class _Product:
    def __init__(self, w: np.ndarray):
        self.w = w

    def __call__(self, z: np.ndarray) -> np.ndarray:
        return z.T @ (z @ self.w)


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """``new`` made orthonormal to ``against`` and in itself; directions that vanish are left out."""
    scale = np.linalg.norm(new, axis=0)
    new = new[:, scale > 0] / scale[scale > 0]
    for _ in range(3):
        new = new - against @ (against.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 1e-10] / size[size > 1e-10]
    if not new.shape[1]:
        return new
    q, r = np.linalg.qr(new)
    q = q[:, abs(np.diag(r)) > 1e-8]
    for _ in range(2):
        q = np.linalg.qr(q - against @ (against.T @ q))[0]
    return q


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of ``A_j x_j = right_j`` for symmetric ``A_j``, all columns side by side; ``product`` applies each
    ``A_j`` to its column."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(right), np.divide(right, beta, where=live, out=np.zeros_like(right))
    d_old, d = np.zeros_like(right), np.zeros_like(right)
    c, s, c_old, s_old = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    eta, beta = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        y = product(v) - beta * v_old  # Lanczos
        alpha = np.einsum("ij,ij->j", v, y)
        y -= alpha * v
        beta_new = np.linalg.norm(y, axis=0)
        r1, r2 = s_old * beta, c * c_old * beta + s * alpha  # earlier rotations on the new column
        low = c * alpha - c_old * s * beta
        r2, r3 = s * alpha + c_old * c * beta, np.hypot(low, beta_new)
        safe = r3 > 0
        c_new = np.divide(low, r3, where=safe, out=np.ones_like(r3))
        s_new = np.divide(beta_new, r3, where=safe, out=np.zeros_like(r3))
        d_new = np.divide(v - r1 * d_old - r2 * d, r3, where=safe, out=np.zeros_like(v))
        x += (c_new * eta) * d_new
        eta = -s_new * eta
        v_old, v = v, np.divide(y, beta_new, where=beta_new > 0, out=np.zeros_like(y))
        d_old, d, c_old, s_old, c, s, beta = d, d_new, c, s, c_new, s_new, beta_new
    return x


def components(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 7,
               corrections: int = CORRECTIONS, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and eigenvectors of a symmetric positive operator, by block
    Jacobi-Davidson; fewer if the rest is nothing beside the largest."""
    wanted = min(wanted, dim)
    most = min(dim, wanted + 3 * corrections)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + corrections))), np.zeros((dim, 0)))
    image = product(basis)
    locked, values, checked = np.zeros((dim, 0)), np.zeros(0), False
    for _ in range(OUTER_STEPS):
        if basis.shape[1]:
            h = basis.T @ image
            theta, turn = np.linalg.eigh((h + h.T) / 2)
            theta, turn = theta[::-1], turn[:, ::-1]
            u, au = basis @ turn, image @ turn
        else:
            theta, u, au = np.zeros(0), basis, image
        top = max([*values, *theta, 0.0])
        residual = au - u * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        whole = locked.shape[1] + basis.shape[1] >= dim  # nothing is outside the subspace
        reached = 32 * np.finfo(float).eps * np.sqrt(dim) * top
        done = 0
        while done < len(theta) and locked.shape[1] + done < wanted and (whole or size[done] <= reached):
            done += 1
        locked, values = np.concatenate((locked, u[:, :done]), 1), np.concatenate((values, theta[:done]))
        basis, image, theta, residual = u[:, done:], au[:, done:], theta[done:], residual[:, done:]
        if locked.shape[1] == wanted or top == 0 or not len(theta) or theta[0] <= NOTHING * top:
            order = np.argsort(-values, kind="stable")
            locked, values = locked[:, order], values[order]
            if not values.size or checked:
                break
            again = product(locked)  # fresh residuals of all
            h = locked.T @ again
            theta, turn = np.linalg.eigh((h + h.T) / 2)
            u, au = locked @ turn[:, ::-1], again @ turn[:, ::-1]
            values = theta[::-1]
            if whole or np.linalg.norm(au - u * values, axis=0).max() <= 2 * reached:
                locked = u
                checked = True
                break
            basis, image = np.concatenate((u, basis), 1), np.concatenate((au, image), 1)
            locked, values = np.zeros((dim, 0)), np.zeros(0)
            continue
        own = slice(0, min(corrections, wanted - locked.shape[1], len(theta)))
        q, e, r = basis[:, own], theta[own], residual[:, own]

        def outside(t: np.ndarray) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - q * np.einsum("ij,ij->j", q, t)

        def corrected(t: np.ndarray) -> np.ndarray:
            t = outside(t)
            return outside(product(t) - t * e)

        t = minres(corrected, -outside(r), inner)
        if locked.shape[1] + basis.shape[1] + t.shape[1] > most:  # restart from the best
            keep = max(own.stop, min(basis.shape[1], most - locked.shape[1] - t.shape[1]))
            basis = _orthonormal(basis[:, :keep], locked)
            image = product(basis)  # anew, so that rounding does not add up
        new = _orthonormal(t, np.concatenate((locked, basis), 1))
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((dim, 1)), np.concatenate((locked, basis), 1))
        if new.shape[1]:
            basis, image = np.concatenate((basis, new), 1), np.concatenate((image, product(new)), 1)
    else:
        raise RuntimeError(f"residuals did not reach double precision in {OUTER_STEPS} steps")
    some = values > NOTHING * max(values, default=0.0)
    return values[some], locked[:, some]


def whiten(vectors: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component."""
    fit = Centred(vectors, id_col, vec_col)
    values, axes = components(fit.times, fit.dim, count) if fit.n > 1 and fit.trace else (np.zeros(0), np.zeros((fit.dim, 0)))
    if not len(values):
        return vectors.sparkSession.createDataFrame([], OUT)
    explained = [float(v) * fit.n ** 3 / fit.trace for v in values]
    scaled = axes / np.sqrt(values)
    k = len(values)
    mean = fit._sum(Shared(fit.spark, _Mean(scaled)), (k,)) / fit.n
    covariance = fit._sum(Shared(fit.spark, _Squares(scaled, mean)), (k, k)) / fit.n
    error = float(abs(covariance - np.eye(k)).max())
    n, dim, centre, exact = fit.n, fit.dim, fit._centre(), fit.exact
    sent = Shared(fit.spark, (scaled, np.array(explained)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, shares = sent.load()
        for ids, x in _blocks(batches, dim):
            ids = unpack([ids]).column(0).combine_chunks()
            for at in range(0, len(x), 1024):
                d = centre(x[at:at + 1024])
                m = len(d)
                dev = pa.array([int(v) if v < 1 << 63 else None for v in _deviations(d, exact)], pa.int64())
                z = (d.astype(np.float64) / n) @ axes
                own = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, m).take(own), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     dev.take(own), pa.array(z.reshape(-1)), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    [f.split()[0] for f in OUT.split(", ")])

    return fit.blocks.mapInArrow(tidied(run), OUT)


class _Mean:
    def __init__(self, axes: np.ndarray):
        self.axes = axes

    def __call__(self, z: np.ndarray) -> np.ndarray:
        return (z @ self.axes).sum(0)


class _Squares:
    def __init__(self, axes: np.ndarray, mean: np.ndarray):
        self.axes, self.mean = axes, mean

    def __call__(self, z: np.ndarray) -> np.ndarray:
        w = z @ self.axes - self.mean
        return w.T @ w
