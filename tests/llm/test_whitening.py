"""Operator 12 against a dense eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.llm import whitening as W
from ranklight.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<double>"


def dense(rows):
    """Ids, exact deviations, z, eigenvalues and eigenvectors by plain NumPy and Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (dim - len(v)) for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    d = [[n * a - s for a, s in zip(row, sums)] for row in x]
    z = np.array(d, float) / max(n, 1)
    values, axes = np.linalg.eigh(z.T @ z / n)
    return [i for i, _ in kept], [sum(a * a for a in row) for row in d], z, values[::-1], axes[:, ::-1]


def check(df, rows, count=32):
    ids, deviations, z, values, axes = dense(rows)
    wanted = min(count, int((values > 1e-12 * values[0]).sum()))
    got = df.toPandas()
    assert len(got) == len(ids) * wanted and set(got["n"]) == {len(ids)} and set(got.component) == set(range(1, wanted + 1))
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    for c in range(1, wanted + 1):
        own = got[got.component == c].sort_values(["vec_id", "deviation", "whitened"])
        assert np.allclose(own.explained, values[c - 1] / values.sum(), rtol=1e-9)
        want = z @ axes[:, c - 1] / np.sqrt(values[c - 1])
        assert math.isclose(abs(own.whitened).sum(), abs(want).sum(), rel_tol=1e-6)
    first = got[got.component == 1]
    key = lambda v: (v is None or v != v, 0 if v is None or v != v else int(v))
    assert sorted(zip(map(key, first.vec_id), map(int, first.deviation))) == sorted(zip(map(key, ids), deviations))


@pytest.mark.parametrize("dim,falling", [(64, 0.9), (64, 1.0), (200, 0.97), (600, 0.995), (5, 0.5), (1, 1.0)])
def test_components_of_an_operator(dim, falling):
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    values = falling ** np.arange(dim)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, axes = W.components(lambda w: a @ w, dim, 32)
    k = min(32, dim)
    assert got == pytest.approx(values[:k], abs=1e-13) and abs(axes.T @ axes - np.eye(k)).max() < 1e-13
    assert abs(a @ axes - axes * got).max() < 1e-13


def test_components_of_low_rank_and_repeated_values():
    rng = np.random.default_rng(1)
    b = rng.standard_normal((300, 7))
    got, axes = W.components(lambda w: b @ (b.T @ w), 300, 32)
    assert got == pytest.approx(np.linalg.eigvalsh(b.T @ b)[::-1], rel=1e-12) and axes.shape == (300, 7)
    values = np.repeat([3.0, 2.0, 1.0, 0.5], 50)
    got, axes = W.components(lambda w: values[:, None] * w, 200, 60)
    assert got == pytest.approx([3.0] * 50 + [2.0] * 10, abs=1e-12)
    assert W.components(lambda w: 0 * w, 20, 3)[0].size == 0


def test_minres_solves():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    right = np.concatenate((rng.standard_normal((30, 3)), np.zeros((30, 1))), 1)
    assert abs(a @ W.minres(lambda t: a @ t, right, 60) - right).max() < 1e-10


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, _, z, values, axes = dense(rows)
    got = QUERIES["op12_embedding_whitening"](spark, sf)
    check(got, rows)
    own = got.toPandas().pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    for c in range(own.shape[1]):
        want = z @ axes[:, c] / np.sqrt(values[c])
        assert min(abs(own[:, c] - want).max(), abs(own[:, c] + want).max()) < 1e-8


def test_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(80)]
    rows += [(100, None), (101, [1.0, None]), (102, [float("nan")] * 6), (103, [float("inf"), 1.0]), (104, []), (105, [0.5, -2.0]), (None, [0.25] * 6)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    check(W.whiten(df), rows)
    check(W.whiten(df, 2), rows, 2)
    clash = df.withColumns({c: F.lit("extra") for c in "i v ids x s m g component n deviation whitened".split()})
    check(W.whiten(clash), rows)
    monkeypatch.setattr(W, "TREE", 1)  # sums over groups of tasks
    monkeypatch.setattr(W, "BLOCK_BYTES", 400)
    check(W.whiten(df), rows)
    assert W.whiten(df.limit(0)).count() == 0
    assert W.whiten(df.filter("vec_id = 5").limit(1)).count() == 0
    assert W.whiten(df.filter("vec_id is null").unionAll(df.filter("vec_id is null"))).count() == 0


def test_huge_entries(spark):
    """Exact deviations beyond a long are null; nothing fails."""
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.5, 3.0])]
    got = W.whiten(spark.createDataFrame(rows, ROWS)).toPandas()
    assert len(got) == 3 and got.deviation.isna().sum() == 2 and np.isfinite(got.whitened).all()
    rows = [(i, [2.0 ** 14 * i, float(i % 3)]) for i in range(12)]
    check(W.whiten(spark.createDataFrame(rows, ROWS)), rows)
