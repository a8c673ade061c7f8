"""Hot keys: one group holding most of the rows must give the same answer as a brute-force check."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ranklight.operators import features, neighbours


def test_signal_features_with_one_hot_user(spark):
    rows = [(0, t, float(t % 13)) for t in range(3000)] + [(u, t, float(u * t)) for u in range(1, 10) for t in range(10)]
    sig = spark.createDataFrame(rows, "user_id bigint, t bigint, value double").repartition(5)
    got = features.signal_features(sig, "user_id", ["t"], "value", 8, 6, 10).toPandas()
    pdf = pd.DataFrame(rows, columns=["user_id", "t", "value"]).sort_values(["user_id", "t"])
    want = []
    for u, g in pdf.groupby("user_id"):
        v = g["value"].to_numpy()
        n = len(v) // 8
        if n == 0:
            continue
        mean = v[: n * 8].reshape(n, 8)[:, :6].mean(axis=0)
        want += [(u, p, float(x)) for p, x in enumerate(np.r_[mean, np.zeros(4)])]
    got = sorted((int(r.user_id), int(r.pos), round(r.value, 9)) for r in got.itertuples())
    assert got == sorted((u, p, round(x, 9)) for u, p, x in want)


def test_grid_with_everything_in_one_cell(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(0, 0.01, size=(300, 4))
    coll = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id bigint, embedding array<double>")
    q = coll.select(F.col("vec_id").alias("query_id"), "embedding")
    grid = {(r.query_id, r.vec_id) for r in neighbours.grid_within(coll, q, 0.02, block_rows=16).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    want = {(i, j) for i, j in zip(*np.nonzero(d <= 0.02))}
    assert grid == want


def test_blocked_knn_with_tiny_blocks(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(120, 3))
    coll = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id bigint, embedding array<double>")
    q = coll.select(F.col("vec_id").alias("query_id"), "embedding")
    got = {(r.query_id, r.rank, r.vec_id) for r in neighbours.knn(coll, q, 3, block_rows=7).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    want = set()
    for i in range(len(pts)):
        order = np.lexsort((np.arange(len(pts)), np.round(d[i], 9)))[:3]
        want |= {(i, r + 1, int(j)) for r, j in enumerate(order)}
    assert got == want
