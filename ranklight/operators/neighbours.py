"""Nearest-neighbour and radius search over vector columns (M8–M14; J4–J6, T2, T3, P9, P10).

Distances are computed by a NumPy kernel over *blocks* of queries × collection rows, inside Spark
tasks; pairs are never emitted as rows, only the k best per query and block (kNN) or the pairs within
the radius (range).  Two physical strategies:

* **literal** — vectors given as Python values (``knn_of``, ``within_of``: the reference's usage, one query at a time) are
  broadcast and ``mapInArrow`` scans the collection where it lies: no shuffle of the collection, and each partition emits
  at most k rows per query.
* **parts** — a table of queries never passes through the driver.  Both tables are packed into blobs of ``PACK_ROWS``
  rows in tasks and written; the collection's blobs are dealt to parts of ``PART_BLOBS``, every query blob visits every
  part, and a task streams them past one part.  Vectors of the collection travel once, queries once for each part.
* **blocked** — keyed strategies (grid, LSH) and small groups: queries and collection meet by a salted key.  Each key (one
  constant key for brute force, a grid cell, or an LSH bucket) is split into ``ceil(rows/block_rows)`` salts of the collection,
  however hot the key; a task holds one of them and streams its visitors past it (:func:`streamed`), with the same kernel.

The final top-k per query is ``row_number() <= k`` (partial ``WindowGroupLimit`` before its shuffle).
Ties at the cut: ``round(dist, 9)`` then the smaller id, in the kernel and in the final ranking.
"""

from __future__ import annotations

import itertools
import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.operators.ranking import top_k
from ranklight.operators.sizing import MAX_BROADCAST_ROWS, bounded
from ranklight.sources.scratch import materialize

PAIR_SCHEMA = "query_id long, vec_id long, dist double"
PACK_ROWS = 1024
PART_BLOBS = 32
VISIT_BLOBS = 64
BLOCK_ROWS = 32_768
VISIT_ROWS = 65_536
TASK_ROWS = 131_072  # vectors that a task of keyed groups sorts, about
CELL_SLACK = 1e-6  # relative widening of grid cells, far above double rounding of a coordinate over a width
METRICS = ("l2", "sqeuclidean")
GROUP = 64  # columns of one minimum


# --------------------------------------------------------------------------------------------------
# kernel (runs inside tasks)

# Memory budget of the kernel, in float64 elements: the distance block and the difference block are
# cut to this size whatever the batch sizes are (16 MB each).
_BUDGET = 2_000_000
_CACHED = 1 << 17  # of one block of pairs' differences


def _dist(Q: np.ndarray, C: np.ndarray, metric: str) -> np.ndarray:
    """Exact distances, difference form (no ‖q‖²+‖c‖²−2q·c cancellation), in chunks of queries so
    the difference block stays within the budget."""
    out = np.empty((Q.shape[0], C.shape[0]), dtype=np.float64)
    step = max(1, _BUDGET // max(1, C.shape[0] * max(1, C.shape[1])))
    for s in range(0, Q.shape[0], step):
        diff = Q[s:s + step, None, :] - C[None, :, :]
        out[s:s + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return np.sqrt(out) if metric == "l2" else out


def _matrix(vectors, dim: int | None = None) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, dim or 0))
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    if dim is not None and m.shape[1] != dim:
        raise ValueError(f"vectors of different dimension: {m.shape[1]} vs {dim}")
    return m


def _rows(lists: pa.Array) -> np.ndarray:
    """An Arrow column of vectors as a matrix; vectors with a null entry are read one by one."""
    flat, sizes = lists.flatten(), pc.list_value_length(lists)
    if flat.null_count or lists.null_count or len(lists) == 0:
        return _matrix(lists.to_pylist())
    if (low := pc.min_max(sizes).as_py())["min"] != low["max"]:
        raise ValueError("vectors of different dimension")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), low["max"])


def _check_dims(Q: np.ndarray, C: np.ndarray) -> None:
    if Q.shape[1] != C.shape[1]:
        raise ValueError(f"vectors of different dimension: {Q.shape[1]} vs {C.shape[1]}")


def _query_chunks(n_queries: int, n_coll: int):
    step = max(1, _BUDGET // max(1, n_coll))
    return range(0, n_queries, step), step


def _finite(X: np.ndarray) -> tuple[np.ndarray, bool]:
    """Which rows have finite entries only, and whether the squared lengths of those are all far from overflow."""
    fine = np.isfinite(X).all(axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.einsum("ij,ij->i", X, X)
    return fine, bool((size[fine] < 1e150).all())


class _Squares:
    """Squared distances by one matrix product a chunk, each within ``error`` of the difference form.

    They only pick candidates: what is kept or returned is decided by :func:`_dist_at`."""

    def __init__(self, Q: np.ndarray, C: np.ndarray):
        qq, cc = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", C, C)
        self.left = np.concatenate((-2.0 * Q, np.ones((len(Q), 1)), qq[:, None]), axis=1)
        self.right = np.ascontiguousarray(np.concatenate((C, cc[:, None], np.ones((len(C), 1))), axis=1).T)
        self.error = 8 * (Q.shape[1] + 4) * np.finfo(float).eps * (qq.max(initial=0.0) + cc.max(initial=0.0))

    def of(self, s: int, step: int) -> np.ndarray:
        return self.left[s:s + step] @ self.right


def _dist_at(Q: np.ndarray, C: np.ndarray, qi: np.ndarray, ci: np.ndarray, metric: str) -> np.ndarray:
    """Exact distances of the pairs ``(qi, ci)``, difference form, in blocks that stay in a core's cache."""
    out = np.empty(len(qi))
    step = max(1, min(len(qi), _CACHED // max(1, Q.shape[1])))
    left, right = np.empty((step, Q.shape[1])), np.empty((step, Q.shape[1]))
    for s in range(0, len(qi), step):
        n = min(step, len(qi) - s)
        diff = np.take(Q, qi[s:s + n], axis=0, out=left[:n], mode="clip")
        diff -= np.take(C, ci[s:s + n], axis=0, out=right[:n], mode="clip")
        np.einsum("jk,jk->j", diff, diff, out=out[s:s + n])
    return np.sqrt(out) if metric == "l2" else out


def _at_most(A: np.ndarray, limit) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the entries up to ``limit``."""
    return np.divmod(np.flatnonzero(A <= limit), A.shape[1])


def _knn_block(qids, Q, cids, C, k: int, metric: str):
    """<= k (query, id, dist) per query, ordered by (round(dist, 9), id).  Per query chunk: squared distances by a matrix
    product; the k-th least of the minima of strided groups bounds the k-th distance; the few pairs up to that bound get
    their exact distance and are sorted (ties at the cut are all kept until the id decides).  Queries that are no finite
    vectors, or meet fewer than k of those, go through all exact distances."""
    if len(qids) == 0 or len(cids) == 0:
        return [], [], []
    _check_dims(Q, C)
    (fine, small), (held, too) = _finite(Q), _finite(C)
    parts = []
    if small and too and fine.any() and held.sum() >= k:
        parts.append(_knn_near(qids[fine], Q[fine], cids[held], C[held], k, metric) if not (fine.all() and held.all())
                     else _knn_near(qids, Q, cids, C, k, metric))
    else:
        fine = np.zeros(len(Q), bool)
    if not fine.all():
        parts.append(_knn_all(qids[~fine], Q[~fine], cids, C, k, metric))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _best(qi, ci, d, qids, cids, kk: int):
    order = np.lexsort((cids[ci], np.round(d, 9), qi))
    qi, ci, d = qi[order], ci[order], d[order]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < kk  # rank inside its query
    return qids[qi[keep]], cids[ci[keep]], d[keep]


def _knn_near(qids, Q, cids, C, k: int, metric: str):
    squares, n, found = _Squares(Q, C), len(cids), []
    groups = n // GROUP
    starts, step = _query_chunks(len(qids), n)
    for s in starts:
        A = squares.of(s, step)
        least = A[:, :groups * GROUP].reshape(len(A), GROUP, groups).min(axis=1) if groups >= 4 * k else A
        bound = np.maximum(np.partition(least, k - 1, axis=1)[:, k - 1] + squares.error, 0.0)
        # what rounds to the same nine places as the k-th is kept
        limit = (np.sqrt(bound) * (1 + 1e-12) + 2e-9) ** 2 if metric == "l2" else bound * (1 + 1e-12) + 2e-9
        qi, ci = _at_most(A, (limit + squares.error)[:, None])
        found.append(_best(qi, ci, _dist_at(Q[s:s + step], C, qi, ci, metric), qids[s:s + step], cids, k))
    return tuple(np.concatenate(x) for x in zip(*found))


def _knn_all(qids, Q, cids, C, k: int, metric: str):
    """The same through all exact distances of a chunk and ``partition``."""
    kk = min(k, len(cids))
    found = []
    starts, step = _query_chunks(len(qids), len(cids))
    for s in starts:
        D = _dist(Q[s:s + step], C, metric)
        key = np.round(D, 9)
        kth = np.partition(key, kk - 1, axis=1)[:, kk - 1] if kk < len(cids) else key.max(axis=1)
        qi, ci = np.nonzero(key <= kth[:, None])
        found.append(_best(qi, ci, D[qi, ci], qids[s:s + step], cids, kk))
    return tuple(np.concatenate(x) for x in zip(*found))


class _Box:
    """Pairs within a box by bitmaps: each coordinate of the collection is cut at its quantiles, and for every cut one bit a row
    says whether the row lies below it.  The rows between two cuts are the exclusive or of two bitmaps, those of all
    coordinates their conjunction.  Cuts are taken outside of the box, so no pair is lost; the caller tests the rest."""

    def __init__(self, C: np.ndarray, cuts: int = 64):
        self.n, dims = C.shape
        self.cuts = np.sort(np.quantile(C, np.linspace(0, 1, cuts + 1)[1:-1], axis=0, method="lower").T, axis=1)
        below = [np.packbits(np.concatenate((np.zeros((1, self.n), bool), C[None, :, i] < self.cuts[i][:, None], np.ones((1, self.n), bool))), axis=1)
                 for i in range(dims)]
        self.below = np.stack(below) if below else np.zeros((0, cuts + 1, 0), np.uint8)
        self.dims = np.arange(dims)

    def near(self, Q: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        qi, ci = [], []
        pad = half * 1e-9 + np.abs(Q) * 1e-12 + 1e-300
        low = np.stack([np.searchsorted(self.cuts[i], Q[:, i] - half - pad[:, i], "right") for i in self.dims], axis=1)
        high = np.stack([np.searchsorted(self.cuts[i], Q[:, i] + half + pad[:, i], "right") for i in self.dims], axis=1) + 1
        for q in range(len(Q)):
            bits = np.bitwise_and.reduce(self.below[self.dims, high[q]] ^ self.below[self.dims, low[q]], axis=0)
            some = np.flatnonzero(bits)
            row, bit = np.nonzero(np.unpackbits(bits[some]).reshape(-1, 8))
            ci.append(some[row] * 8 + bit)
            qi.append(np.full(len(row), q))
        return np.concatenate(qi), np.concatenate(ci)


_BOXES: list[tuple[np.ndarray, _Box]] = []  # of the matrix that the last batch of queries met


def _box_of(C: np.ndarray) -> _Box:
    if not _BOXES or _BOXES[0][0] is not C:
        _BOXES[:] = [(C, _Box(C))]
    return _BOXES[0][1]


def _range_block(qids, Q, cids, C, radius: float, metric: str, box: float | None = None):
    """All (query, id, dist) with dist <= radius (inclusive); optional box filter ``|q-c|_inf <= box``.

    Candidates come from squared distances by a matrix product (with a box and no radius: from bitmaps); every one is
    tested in the difference form."""
    if len(qids) == 0 or len(cids) == 0:
        return [], [], []
    _check_dims(Q, C)
    (fine, small), (held, too) = _finite(Q), _finite(C)
    fast = small and too and Q.shape[1] > 0 and (math.isfinite(radius) or box is not None and math.isfinite(box))
    if fast:  # what is not finite lies in no finite radius and no finite box
        qids, Q, cids, C = (x if m.all() else x[m] for x, m in ((qids, fine), (Q, fine), (cids, held), (C, held)))
        if len(qids) == 0 or len(cids) == 0 or metric == "l2" and radius < 0:
            return [], [], []
    found = []
    if fast and not math.isfinite(radius):
        bits = _box_of(C)
    elif fast:
        squares = _Squares(Q, C)
        limit = (radius * radius if metric == "l2" else radius) * (1 + 1e-12) + squares.error
    starts, step = _query_chunks(len(qids), len(cids))
    for s in starts:
        own = Q[s:s + step]
        if not fast:
            D = _dist(own, C, metric)
            qi, ci = np.nonzero(D <= radius) if box is None or math.isfinite(radius) else np.nonzero(np.ones(D.shape, bool))
        elif math.isfinite(radius):
            qi, ci = _at_most(squares.of(s, step), limit)
        else:
            qi, ci = bits.near(own, box)
        if box is not None:
            keep = np.ones(len(qi), bool)
            most = max(1, _BUDGET // max(1, C.shape[1]))
            for b in range(0, len(qi), most):
                keep[b:b + most] = (np.abs(own[qi[b:b + most]] - C[ci[b:b + most]]) <= box).all(axis=1)
            qi, ci = qi[keep], ci[keep]
        d = _dist_at(own, C, qi, ci, metric)
        keep = d <= radius
        found.append((qids[s:s + step][qi[keep]], cids[ci[keep]], d[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _frame(q, c, d) -> pd.DataFrame:
    return pd.DataFrame({"query_id": np.asarray(q, dtype=np.int64), "vec_id": np.asarray(c, dtype=np.int64),
                         "dist": np.asarray(d, dtype=np.float64)})


# --------------------------------------------------------------------------------------------------
# physical strategies

def _prepare(df: DataFrame, id_col: str, vec_col: str, id_name: str, vec_name: str) -> DataFrame:
    """Id and vector under fixed names.  Rows without a vector (failed extractions, P6) take no part."""
    return df.select(F.col(id_col).cast("long").alias(id_name),
                     F.col(vec_col).cast("array<double>").alias(vec_name)).filter(F.col(vec_name).isNotNull())


def _broadcast_path(coll: DataFrame, rows: list, mode: str, param: float, metric: str,
                    box: float | None = None) -> DataFrame:
    """Literal query vectors ``(id, vector)`` broadcast; ``mapInArrow`` over the collection where it lies."""
    spark = coll.sparkSession
    qids = np.array([i for i, _ in rows], dtype=np.int64)
    Q = _matrix([v for _, v in rows]) if rows else np.zeros((0, 0))
    bq = spark.sparkContext.broadcast((qids, Q))

    def run(batches):
        qids, Q = bq.value
        best_q, best_c, best_d = [], [], []
        for b in batches:
            if b.num_rows == 0 or len(qids) == 0:
                continue
            cids = b.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = b.column("cv")
            lens = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            if len(set(lens.tolist()) | {Q.shape[1]}) != 1:
                raise ValueError("vectors of different dimension")
            C = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(cids), Q.shape[1])
            if mode == "knn":
                q, c, d = _knn_block(qids, Q, cids, C, int(param), metric)
                best_q.append(q), best_c.append(c), best_d.append(d)
                # keep the partition's running top-k bounded: re-cut after every batch
                q, c, d = np.concatenate(best_q), np.concatenate(best_c), np.concatenate(best_d)
                keep = _cut(q, c, d, int(param))
                best_q, best_c, best_d = [q[keep]], [c[keep]], [d[keep]]
            else:
                q, c, d = _range_block(qids, Q, cids, C, param, metric, box)
                if len(q):
                    yield pa.RecordBatch.from_pandas(_frame(q, c, d), preserve_index=False)
        if mode == "knn" and best_q:
            yield pa.RecordBatch.from_pandas(_frame(best_q[0], best_c[0], best_d[0]), preserve_index=False)

    return coll.mapInArrow(run, PAIR_SCHEMA)


def _narrow(b: pa.RecordBatch) -> pa.RecordBatch:
    """Ids and vectors with the entries as 32-bit floats, if all of them are such numbers (most embeddings are)."""
    ids, lists = b.columns
    kind = pa.list_(pa.float32())
    with np.errstate(over="ignore", invalid="ignore"):
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        exact = flat.dtype == np.float64 and bool((flat.astype(np.float32) == flat).all())
    return pa.RecordBatch.from_arrays([ids, lists.cast(kind) if exact else lists], names=b.schema.names)


def _packed(df: DataFrame, name: str) -> DataFrame:
    """``df`` (id, vector) as a written table ``own, blob`` of blobs of ``PACK_ROWS`` rows; ``own`` numbers them for good."""
    def run(batches):
        for b in batches:
            b = _narrow(b)
            for at in range(0, b.num_rows, PACK_ROWS):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as out:
                    out.write_batch(b.slice(at, PACK_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["blob"])

    return materialize(df.mapInArrow(run, "blob binary").select(F.monotonically_increasing_id().alias("own"), "blob"), name)


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    t = pa.ipc.open_stream(blob).read_all()
    return t.column(0).to_numpy(), _rows(t.column(1).combine_chunks())


def _parts_path(coll: DataFrame, queries: DataFrame, mode: str, param: float, metric: str) -> DataFrame:
    """Every query blob meets every part of the collection's blobs.  A task holds one part and one query blob."""
    held, asked = _packed(coll, "knn-vectors"), _packed(queries, "knn-queries")
    parts = max(1, math.ceil(held.count() / PART_BLOBS))
    both = held.select(F.pmod(F.xxhash64("own"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "blob").unionAll(
        asked.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "blob"))
    # visitors of a part are dealt to copies of it: where there are fewer parts than tasks, and ``VISIT_BLOBS`` to a copy, about
    tasks = int(coll.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = max(math.ceil(tasks / parts), math.ceil(asked.count() / VISIT_BLOBS))
    both = both.withColumn("copy", F.when(F.col("kind") == 1, F.array(F.pmod(F.xxhash64("blob"), F.lit(copies)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.lit(copies - 1)))).select("part", F.explode("copy").alias("copy"), "kind", "blob")

    def run(batches):
        at, ids, vectors = None, [], []
        for b in batches:
            for part, copy, kind, blob in zip(*(c.to_pylist() for c in b.columns)):
                if (part, copy) != at:
                    at, ids, vectors = (part, copy), [], []
                own, matrix = _opened(blob)
                if kind == 0:
                    ids.append(own), vectors.append(matrix)
                    continue
                if len(ids) > 1:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                if ids and mode == "knn":
                    yield pa.RecordBatch.from_pandas(_frame(*_knn_block(own, matrix, ids[0], vectors[0], int(param), metric)), preserve_index=False)
                elif ids:  # the hits of a vector stand together: what is joined to it (names) repeats and is stored once
                    c, q, d = _range_block(ids[0], vectors[0], own, matrix, param, metric)
                    yield pa.RecordBatch.from_pandas(_frame(q, c, d), preserve_index=False)

    return both.repartitionById(parts * copies, F.col("part") * copies + F.col("copy")).sortWithinPartitions("kind").mapInArrow(run, PAIR_SCHEMA)


def _cut(q, c, d, k: int) -> np.ndarray:
    """Indices of the first k rows per query by (query, round(dist, 9), id)."""
    order = np.lexsort((c, np.round(d, 9), q))
    qs = q[order]
    first = np.r_[0, np.flatnonzero(qs[1:] != qs[:-1]) + 1]
    rank = np.arange(len(qs)) - np.repeat(first, np.diff(np.r_[first, len(qs)]))
    return order[rank < k]


def streamed(held: DataFrame, asked: DataFrame, keys: list[str], meet, tasks: int | None = None, extra: str | None = None) -> DataFrame:
    """``held`` (``keys``, ``vec_id``, ``cv``) and ``asked`` (``keys``, ``query_id``, ``qv``) meet by key: a task holds the vectors
    of one key and streams the queries past them, some thousand at a time.  ``meet(query ids, queries, ids, vectors)`` returns
    queries, ids and distances; ``extra`` names one more column that both sides have, handed over as Arrow arrays."""
    more = [extra] if extra else []
    both = held.select(*keys, F.lit(0).alias("kind"), F.col("vec_id").alias("id"), F.col("cv").alias("v"), *more).unionAll(
        asked.select(*keys, F.lit(1).alias("kind"), F.col("query_id").alias("id"), F.col("qv").alias("v"), *more))
    n = len(keys)

    def run(batches):
        at, ids, vectors, others = None, [], [], []
        for b in batches:
            marks = list(zip(*(c.to_pylist() for c in b.columns[:n + 1])))
            heads = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for lo, hi in zip(heads, heads[1:]):
                if hi == lo:
                    continue
                *key, kind = marks[lo]
                if key != at:
                    at, ids, vectors, others = key, [], [], []
                part = b.slice(lo, hi - lo)
                if kind == 0:
                    ids.append(part.column(n + 1).to_numpy()), vectors.append(_rows(part.column(n + 2)))
                    others += [part.column(n + 3)] if extra else []
                    continue
                if len(ids) > 1:
                    if len({v.shape[1] for v in vectors}) > 1:
                        raise ValueError("vectors of different dimension")
                    ids, vectors, others = [np.concatenate(ids)], [np.concatenate(vectors)], [pa.concat_arrays(others)] if extra else []
                if ids:
                    own = (part.column(n + 1).to_numpy(), _rows(part.column(n + 2)), ids[0], vectors[0])
                    found = meet(*own, part.column(n + 3), others[0]) if extra else meet(*own)
                    yield pa.RecordBatch.from_pandas(_frame(*found), preserve_index=False)

    tasks = max(tasks or 0, int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(tasks, *keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, PAIR_SCHEMA)


def _blocked_path(coll: DataFrame, queries: DataFrame, ckey: Column | None, qkeys: Column | None, mode: str,
                  param: float, metric: str, block_rows: int = BLOCK_ROWS, box: float | None = None) -> DataFrame:
    """Salted meeting by key.  ``ckey``: one key per collection row; ``qkeys``: array of keys a query must meet;
    both ``None`` means brute force (every query meets every row).

    Per-key counts on both sides (keys seen on one side only are dropped here: pruning) give ``ceil(rows/block_rows)`` salts for
    the collection, so no task holds more of it at once, about; a query visits all of them.  A key with very many visitors is
    held by several tasks, one for ``VISIT_ROWS`` of them.  Vectors move once, to their groups, in as many tasks as keep a
    task's sort in memory.  Brute force: blocks of ``block_rows`` stand in tiles of
    ``BLOCK_ROWS``, which is what a query visits, and the queries of a tile meet it ``block_rows`` at a time; the two table
    counts are scalar subqueries, so there is no join at all, only ``explode(sequence(...))``."""
    tasks = None
    if ckey is None:
        tile = max(block_rows, BLOCK_ROWS)
        cs = F.greatest(F.lit(1), F.ceil(coll.select(F.count(F.lit(1))).scalar() / F.lit(tile))).cast("int")
        qs = F.greatest(F.lit(1), F.ceil(queries.select(F.count(F.lit(1))).scalar() / F.lit(tile))).cast("int")
        c = coll.withColumn("key", F.lit(0)).withColumn("cs", cs).withColumn("qs", qs)
        q = queries.withColumn("key", F.lit(0)).withColumn("cs", cs).withColumn("qs", qs)
    else:
        c = coll.withColumn("key", ckey)
        q = queries.withColumn("key", F.explode(qkeys))
        cn = c.groupBy("key").agg(F.count(F.lit(1)).alias("cn"))
        qn = q.groupBy("key").agg(F.count(F.lit(1)).alias("qn"))
        salts = (cn.join(qn, "key")
                   .withColumn("cs", F.greatest(F.lit(1), F.ceil(F.col("cn") / F.lit(block_rows))).cast("int"))
                   .withColumn("qs", F.greatest(F.lit(1), F.ceil(F.col("qn") / F.lit(VISIT_ROWS))).cast("int")))
        # counted before any vector moves; a broadcast drops the visits to empty keys where their rows are made
        salts = materialize(salts, "key-salts")
        moved = salts.agg(F.coalesce(F.sum(F.col("cn") * F.col("qs") + F.col("qn") * F.col("cs")), F.lit(0))).first()[0]
        tasks = math.ceil(moved / TASK_ROWS)
        salts = salts.select("key", "cs", "qs")
        salts = F.broadcast(salts) if bounded(salts, MAX_BROADCAST_ROWS) else salts
        c, q = c.join(salts, "key"), q.join(salts, "key")
    c2 = (c.withColumn("csalt", F.pmod(F.xxhash64("vec_id"), F.col("cs")).cast("int"))
           .withColumn("qsalt", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
           .select("key", "csalt", "qsalt", "vec_id", "cv"))
    q2 = (q.withColumn("qsalt", F.pmod(F.xxhash64("query_id"), F.col("qs")).cast("int"))
           .withColumn("csalt", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)))
           .select("key", "csalt", "qsalt", "query_id", "qv"))
    step = block_rows if ckey is None else VISIT_ROWS

    def meet(qids, Q, cids, C):
        found = [_knn_block(qids[s:s + step], Q[s:s + step], cids, C, int(param), metric) if mode == "knn" else
                 _range_block(qids[s:s + step], Q[s:s + step], cids, C, param, metric, box) for s in range(0, len(qids), step)]
        return [np.concatenate(x) for x in zip(*found)]

    return streamed(c2, q2, ["key", "csalt", "qsalt"], meet, tasks)


def _pairs(collection: DataFrame, queries: DataFrame, mode: str, param: float, metric: str,
           id_col: str, vec_col: str, query_id_col: str, query_vec_col: str, block_rows: int | None) -> DataFrame:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    coll = _prepare(collection, id_col, vec_col, "vec_id", "cv")
    qs = _prepare(queries, query_id_col, query_vec_col, "query_id", "qv")
    if block_rows is None:
        return _parts_path(coll, qs, mode, param, metric)
    return _blocked_path(coll, qs, None, None, mode, param, metric, block_rows)


# --------------------------------------------------------------------------------------------------
# public operators

NO_HITS = "query_id long, rank long, vec_id long, dist double"


def knn(collection: DataFrame, queries: DataFrame, k: int, metric: str = "l2", id_col: str = "vec_id",
        vec_col: str = "embedding", query_id_col: str = "query_id", query_vec_col: str = "embedding",
        block_rows: int | None = None) -> DataFrame:
    """M8 (``l2``) / M12 (``sqeuclidean``): exact k nearest per query → ``query_id, rank, vec_id, dist``.
    ``k`` larger than the collection returns every row (Q16); ``k <= 0`` returns nothing.  With ``block_rows`` both tables
    meet in salted groups of so many rows instead of parts."""
    if k <= 0:
        return queries.sparkSession.createDataFrame([], NO_HITS)
    pairs = _pairs(collection, queries, "knn", k, metric, id_col, vec_col, query_id_col, query_vec_col, block_rows)
    return top_k(pairs, k, score="dist", item="vec_id", descending=False).select("query_id", "rank", "vec_id", "dist")


def within(collection: DataFrame, queries: DataFrame, radius: float, metric: str = "l2", id_col: str = "vec_id",
           vec_col: str = "embedding", query_id_col: str = "query_id", query_vec_col: str = "embedding",
           block_rows: int | None = None) -> DataFrame:
    """Every collection row with distance ≤ ``radius`` (inclusive, in the metric's unit) →
    ``query_id, vec_id, dist``.  Order with :func:`order_hits` (T3) when an order is needed."""
    return _pairs(collection, queries, "range", float(radius), metric, id_col, vec_col, query_id_col, query_vec_col, block_rows)


def knn_of(collection: DataFrame, vectors: list[tuple[int, list[float]]], k: int, metric: str = "l2", id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """:func:`knn` for vectors given as Python values ``(query id, vector)``."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    if k <= 0 or not vectors:
        return collection.sparkSession.createDataFrame([], NO_HITS)
    pairs = _broadcast_path(_prepare(collection, id_col, vec_col, "vec_id", "cv"), vectors, "knn", k, metric)
    return top_k(pairs, k, score="dist", item="vec_id", descending=False).select("query_id", "rank", "vec_id", "dist")


def within_of(collection: DataFrame, vectors: list[tuple[int, list[float]]], radius: float, metric: str = "l2",
              id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """:func:`within` for vectors given as Python values ``(query id, vector)``."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    return _broadcast_path(_prepare(collection, id_col, vec_col, "vec_id", "cv"), vectors, "range", float(radius), metric)


def order_hits(pairs: DataFrame) -> DataFrame:
    """Range hits by query, distance, id — a range-partitioned sort, so a query with very many
    hits is spread over several tasks instead of one window partition."""
    return pairs.orderBy("query_id", F.round("dist", 9), "vec_id")


def top_dimensions(collection: DataFrame, vec_col: str, m: int) -> list[int]:
    """Indices of the ``m`` highest-variance coordinates (d numbers reach the driver, not rows)."""
    d = collection.select(F.max(F.size(vec_col))).first()[0] or 0
    v = collection.select(*[F.var_pop(F.element_at(vec_col, i + 1)).alias(f"v{i}") for i in range(d)]).first()
    ranked = sorted(range(d), key=lambda i: (-(v[i] or 0.0), i))
    return ranked[:m]


def grid_within(collection: DataFrame, queries: DataFrame, radius: float, metric: str = "l2", dims: int = 3,
                id_col: str = "vec_id", vec_col: str = "embedding", query_id_col: str = "query_id",
                query_vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, axes: str = "coordinates") -> DataFrame:
    """Exact radius search through a grid index (J6 + P10 + P9).

    Cells have width equal to the box half-width on the ``dims`` highest-variance coordinates, so every
    point within the radius lies in the query's cell or a neighbouring one: queries are exploded to the
    3^dims neighbour cells, points keep their one cell, and the salted cogroup pairs them.  Cells are
    wider than the radius by ``CELL_SLACK`` so that rounding cannot move a hit two cells away; inside a
    group only the exact distance decides.  Result equals :func:`within`."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")
    half = float(radius) if metric == "l2" else math.sqrt(max(float(radius), 0.0))
    coll = _prepare(collection, id_col, vec_col, "vec_id", "cv")
    qs = _prepare(queries, query_id_col, query_vec_col, "query_id", "qv")
    if half <= 0:
        # zero radius: only identical points; the cell is the point itself (the box test does the rest)
        own = [F.transform(v, lambda x: x + 0.0) for v in ("cv", "qv")]  # one zero
        return _blocked_path(coll, qs, own[0], F.array(own[1]), "range", float(radius), metric, block_rows, box=0.0)
    if axes == "pca":
        # Cells on the leading principal directions: a projection onto a unit direction never exceeds
        # the distance, so the ±1-cell rule stays exact.
        from ranklight.operators.features import fit_reduction

        red = fit_reduction(coll, "cv", n_components=dims)
        coll = red.transform(coll, "cp").withColumnRenamed("cp", "_axes")
        qs = red.transform(qs.withColumnRenamed("qv", "cv"), "cp").withColumnRenamed("cv", "qv") \
            .withColumnRenamed("cp", "_axes")
        picked = list(range(dims))
        src_c, src_q = "_axes", "_axes"
    elif axes == "coordinates":
        picked = top_dimensions(coll, "cv", dims)
        src_c, src_q = "cv", "qv"
    else:
        raise ValueError(f"unknown grid axes {axes!r}; choose 'coordinates' or 'pca'")

    width = half * (1 + CELL_SLACK)

    def cell(v: str, offs=None) -> Column:
        return F.array(*[(F.floor(F.element_at(v, a + 1) / F.lit(width)) + F.lit(o)).cast("long")
                         for a, o in zip(picked, offs or [0] * len(picked))])

    qkeys = F.array(*[cell(src_q, offs) for offs in itertools.product((-1, 0, 1), repeat=len(picked))])
    return _blocked_path(coll, qs, cell(src_c), qkeys, "range", float(radius), metric, block_rows)


def typical_distance(collection: DataFrame, k: int, sample: int = 1000) -> tuple[float, int]:
    """The median distance of vectors to their k-th nearest, among ``sample`` vectors drawn by a hash (a bounded number, on the
    driver), and the dimension."""
    rows = collection.select("cv").orderBy(F.xxhash64("cv", F.lit(5)), "cv").limit(sample).collect()
    x = _matrix([r.cv for r in rows])
    if len(x) < 2:
        return 1.0, max(1, x.shape[1])
    d = np.sort(_dist(x, x, "l2"), axis=1)[:, min(k, len(x) - 1)]
    return float(np.median(d)) or float(d.max()) or 1.0, max(1, x.shape[1])


def lsh_knn(collection: DataFrame, queries: DataFrame, k: int, bucket_length: float | None = None, tables: int = 4,
            seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding", query_id_col: str = "query_id",
            query_vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, miss: float = 0.05, report: dict | None = None) -> DataFrame:
    """Approximate kNN through Spark ML's ``BucketedRandomProjectionLSH``: ``min(k, n)`` rows for every query, of which a
    true neighbour is missing with probability ``miss`` at most.

    Buckets are twice as wide as a neighbour's usual projected distance (the sampled k-th distance over the root of the
    dimension), whatever the scale of the data.  In each table a query meets its own bucket and the neighbouring one whose
    border is nearer (multi-probe); candidates are ranked by exact distance.  A vector is missed only if its projected
    distance passes the far border in every table: for a vector at distance r along random directions the chance is at most
    ``exp(-d * sum of squared margins / (2 r * r))``.  Queries whose k-th candidate is so far that this exceeds ``miss``, or that
    have fewer than k candidates, are answered exactly by :func:`knn`.  ``report`` gets the numbers of ``queries`` and of those
    ``completed`` so."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if k <= 0:
        return queries.sparkSession.createDataFrame([], NO_HITS)
    coll = _prepare(collection, id_col, vec_col, "vec_id", "cv")
    rows = _prepare(queries, query_id_col, query_vec_col, "query_id", "qv").withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "lsh-queries")  # row numbers are fixed from here on: rows of one id stay apart
    usual, dim = typical_distance(coll, k)
    width = bucket_length or 2.0 * usual / math.sqrt(dim)
    fine = 1024  # the model's buckets are parts of ours, so that the place inside a bucket is known
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=width / fine, numHashTables=tables,
                                        seed=seed).fit(coll.withColumn("features", array_to_vector("cv")))

    def placed(df: DataFrame, vec: str) -> DataFrame:
        h = model.transform(df.withColumn("features", array_to_vector(vec)))
        at = F.element_at(vector_to_array("h"), 1) / fine
        return h.select(*df.columns, F.posexplode("hashes").alias("t", "h")).withColumn("at", at).withColumn("b", F.floor("at"))

    def key(b: Column) -> Column:
        return F.struct(F.col("t").cast("long").alias("t"), b.cast("long").alias("b"))

    ch = placed(coll, "cv").select("vec_id", "cv", key(F.col("b")).alias("hk"))
    inside = F.col("at") - F.col("b")
    side = F.when(inside < 0.5, F.col("b") - 1).otherwise(F.col("b") + 1)
    margin = (F.greatest(inside, 1 - inside) - 1 / fine) * width  # to the far border; beyond the near one is probed
    probed = placed(rows, "qv").select("row", "qv", F.array(key(F.col("b")), key(side)).alias("keys"), margin.alias("margin"))
    asked = probed.select(F.col("row").alias("query_id"), "qv", F.explode("keys").alias("hk"))
    pairs = _blocked_path(ch, asked, F.col("hk"), F.array(F.col("hk")), "knn", k, "l2", block_rows)
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("dist").alias("dist"))
    hits = materialize(top_k(pairs, k, score="dist", item="vec_id", descending=False), "lsh-hits")
    sure = probed.groupBy("row").agg(F.sum(F.col("margin") * F.col("margin")).alias("squares"))
    kth = hits.groupBy(F.col("query_id").alias("row")).agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("far"))
    needed = F.col("far") * F.col("far") * (2.0 * math.log(1.0 / miss) / dim)
    late = sure.join(kth, "row", "left").filter((F.coalesce("n", F.lit(0)) < k) | (F.col("squares") < needed)).select("row")
    late = materialize(rows.join(late, "row", "left_semi"), "lsh-late")
    if report is not None:
        report.update(queries=rows.count(), completed=late.count())
    rest = knn(coll, late, k, "l2", "vec_id", "cv", "row", "qv")
    hits = hits.join(late.select(F.col("row").alias("query_id")), "query_id", "left_anti").select(
        "query_id", "rank", "vec_id", "dist").unionAll(rest)
    return hits.withColumnRenamed("query_id", "row").join(rows.select("row", "query_id"), "row").select(
        "query_id", "rank", "vec_id", "dist")


# The reference's store names mapped to our operators (Q25: unknown names raise).
VECTOR_METHODS = {
    "sequential": ("exact", "l2"),
    "grid": ("grid", "l2"),
    "flat": ("exact", "sqeuclidean"),
    "lsh": ("lsh", "l2"),
    "pivot": ("pivot", "l2"),
    "zorder": ("zorder", "l2"),
}


def _named_columns(kw: dict) -> tuple[dict, dict]:
    """Column names for an index build and for a search on it."""
    return ({c: kw[c] for c in ("id_col", "vec_col") if c in kw}, {c: kw[c] for c in ("query_id_col", "query_vec_col") if c in kw})


def vector_search(collection: DataFrame, queries: DataFrame, k: int = 10, radius: float = 1.0, is_knn: bool = True,
                  method: str = "sequential", names: DataFrame | None = None, root: str = "media",
                  reduction=None, max_broadcast_rows: int = MAX_BROADCAST_ROWS, **kw) -> DataFrame:
    """kNN or range by flag, with names and paths (J4, F14).  ``names``: ``(vec_id, name)``, broadcast when a count has
    proved them small: hits, of which a radius has a share of all pairs, stay where they are found.
    ``reduction``: the stored model (M15, S9) that the collection was reduced with; the queries' raw
    features are reduced with it here."""
    if reduction is not None:
        vec = kw.get("query_vec_col", "embedding")
        raw = queries.filter(F.col(vec).isNotNull()).withColumnRenamed(vec, reduction.vec_col)
        queries = reduction.transform(raw, "_reduced").drop(reduction.vec_col).withColumnRenamed("_reduced", vec)
    try:
        how, metric = VECTOR_METHODS[method]
    except KeyError:
        raise ValueError(f"unknown vector method {method!r}; choose one of {sorted(VECTOR_METHODS)}") from None
    if is_knn:
        if how == "lsh":
            hits = lsh_knn(collection, queries, k, **kw)
        elif how in ("pivot", "grid", "zorder"):  # exact kNN through a candidate index, as the reference's tree
            from ranklight.operators import pivots

            own, asked = _named_columns(kw)
            hits = pivots.knn(pivots.build(collection, **own), queries, k, metric, **asked)
        else:
            hits = knn(collection, queries, k, metric, **kw)
    else:
        if how == "grid":
            hits = grid_within(collection, queries, radius, metric, **kw)
        elif how == "pivot":
            from ranklight.operators import pivots

            own, asked = _named_columns(kw)
            hits = pivots.within(pivots.build(collection, **own), queries, radius, metric, **asked)
        elif how == "zorder":
            from ranklight.operators import zorder
            from ranklight.session import checkpoint_dir

            own, asked = _named_columns(kw)
            path = f"{checkpoint_dir(collection.sparkSession).rstrip('/')}/ranklight/zorder-{uuid.uuid4().hex}"
            zorder.save(collection, path, **own)
            hits = zorder.within(zorder.load(collection.sparkSession, path), queries, radius, metric, **asked)
        else:
            hits = within(collection, queries, radius, metric, **kw)
        hits = hits.withColumn("rank", F.lit(None).cast("long"))
    if names is not None:
        names = names.select("vec_id", "name", F.concat_ws("/", F.lit(root), F.col("name")).alias("path"))
        hits = hits.join(F.broadcast(names) if bounded(names, max_broadcast_rows) else names, "vec_id")
    return hits
