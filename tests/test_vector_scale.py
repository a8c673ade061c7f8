import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import neighbours, pivots, zorder


def _pairs(Q, C, metric):
    with np.errstate(all="ignore"):
        sq = ((Q[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
        return np.sqrt(sq) if metric == "l2" else sq


@pytest.mark.parametrize("metric", ["l2", "sqeuclidean"])
@pytest.mark.parametrize("kind", ["normal", "ties", "far", "not finite"])
def test_kernels_equal_plain_loops_and_form_no_pair_differences(kind, metric, monkeypatch):
    rng = np.random.default_rng(1)
    C, Q = rng.normal(size=(900, 6)), rng.normal(size=(70, 6))
    if kind == "ties":
        C, Q = np.round(C), np.round(Q)
    if kind == "far":
        C, Q = C * 1e-3 + 500, Q * 1e-3 + 500
    if kind == "not finite":
        C[::7, 0], C[3::11, 2] = np.nan, np.inf
    ids, qids, D = rng.permutation(900), np.arange(70), _pairs(Q, C, metric)

    def refused(*a):
        raise AssertionError("differences of all pairs")

    monkeypatch.setattr(neighbours, "_dist", refused)
    q, c, d = neighbours._knn_block(qids, Q, ids, C, 5, metric)
    want = [(i, j) for i in range(70) for j in ids[np.lexsort((ids, np.round(D[i], 9)))[:5]]]
    assert list(zip(q, c)) == want
    radius = float(np.nanmedian(D))
    q, c, d = neighbours._range_block(qids, Q, ids, C, radius, metric)
    assert set(zip(q, c)) == {(i, ids[j]) for i, j in zip(*np.nonzero(D <= radius))} and (d <= radius).all()
    near = (np.abs(Q[:, None, :] - C[None, :, :]) <= 1.0).all(axis=2)
    q, c, d = neighbours._range_block(qids, Q, ids, C, float("inf"), metric, 1.0)
    assert set(zip(q, c)) == {(i, ids[j]) for i, j in zip(*np.nonzero(near))}


def _points(spark, n=400):
    rng = np.random.default_rng(2)
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, 5)))],
                                 "vec_id bigint, embedding array<double>")


def test_a_query_travels_once_to_each_part(spark, monkeypatch):
    e = _points(spark)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    sent = []
    monkeypatch.setattr(pivots, "streamed", lambda held, asked, *a: sent.append(asked) or neighbours.streamed(held, asked, *a))
    monkeypatch.setattr(zorder, "streamed", lambda held, asked, *a: sent.append(asked) or neighbours.streamed(held, asked, *a))
    index = pivots.build(e, pivots=8, ring_rows=16)
    want = {(r.query_id, r.vec_id) for r in neighbours.within(e, q, 9.0).collect()}
    got = pivots.within(index, q, 9.0, ring_rows=16)
    assert {(r.query_id, r.vec_id) for r in got.collect()} == want
    from ranklight.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/zorder-scale"
    zorder.save(e, path, dims=2, bits=4, block_rows=8)
    got = zorder.within(zorder.load(spark, path), q, 9.0)
    assert {(r.query_id, r.vec_id) for r in got.collect()} == want
    assert [s.count() for s in sent] == [2 * 400, 2 * 400]  # 25 rings or more, 50 blocks; two parts each
