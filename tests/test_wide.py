"""Range finder for wide vectors and posting lookup by directory."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import features, indexing, lookup, wide


def table(spark, x):
    return spark.createDataFrame([(i, None if v is None else [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, v array<double>")


def test_same_variances_as_the_dense_path(spark, sf001):
    e = spark.read.parquet(f"{sf001}/embeddings.parquet")
    dense = features.fit_reduction(e, "embedding")
    for settings in ({"components": 64}, {"components": 54}):
        red = wide.fit(e.repartition(7), "embedding", **settings)
        assert red.ratios[:40] == pytest.approx(dense.ratios[:40], abs=1e-6)
    few = wide.fit(e, "embedding", components=64, variance=0.9)
    assert few.n == features.components_for(dense.ratios, 0.9)


def test_components_of_decaying_spectrum(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40)) * 0.6 ** np.arange(40) @ np.linalg.qr(rng.normal(size=(90, 40)))[0].T + 5
    values = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
    df = table(spark, [*x, None]).repartition(20)
    red = wide.fit(df, "v", components=8)
    assert red.ratios == pytest.approx(values[:8] / values.sum(), abs=1e-9)
    assert red.total_variance == pytest.approx(values.sum() / 299)
    assert abs(red.axes @ red.axes.T - np.eye(8)).max() < 1e-12
    out = {r.vec_id: r.reduced for r in red.transform(df).collect()}
    assert out[300] is None and np.allclose([out[i] for i in range(300)], (x - x.mean(0)) @ red.axes.T)


def test_twenty_thousand_dimensions(spark):
    rng = np.random.default_rng(3)
    basis = rng.normal(size=(5, 20_000)) / 100
    x = rng.normal(size=(60, 5)) * [9, 7, 5, 3, 1] @ basis
    red = wide.fit(table(spark, x).repartition(4), "v", components=5, oversample=5)
    values = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
    assert red.ratios == pytest.approx(values[:5] / values.sum(), abs=1e-9) and red.axes.shape == (5, 20_000)


def test_wide_edges(spark):
    with pytest.raises(ValueError):
        wide.fit(table(spark, [None]), "v", components=2)
    with pytest.raises(Exception):
        wide.fit(table(spark, [[1, 2], [1, 2, 3]]), "v", components=2)
    with pytest.raises(Exception):
        wide.fit(table(spark, [[1, float("nan")], [1, 2]]), "v", components=2)
    same = wide.fit(table(spark, [[1, 2]] * 5), "v", components=2)
    assert same.total_variance == 0 and set(same.ratios) <= {0.0}


def test_posting_lookup(spark):
    rng = np.random.default_rng(1)
    docs = spark.createDataFrame([(i * 3 - 50, " ".join(rng.choice(["hot", "a", "b", "c", f"w{i % 50}"], size=8)) + " hot") for i in range(700)],
                                 "doc_id bigint, text string")
    postings = indexing.build_index(docs, stopwords=()).postings
    want = {(r.term, r.doc_id): r.tf for r in postings.collect()}
    pairs = [(t, d) for t in ("hot", "a", "w7", "unknown") for d in range(-55, 2060, 1)] + [("hot", -50)] * 3 + [(None, 1), ("a", None)]
    for size, fan in ((1, 4), (16, 3), (100, 256), (4096, 256)):
        index = lookup.build(postings, block_size=size, fan=fan)
        assert index.blocks.filter(F.size("doc_ids") > size).count() == 0
        got = lookup.lookup(index, spark.createDataFrame(pairs, "term string, doc_id bigint").withColumn("x", F.lit(1)), block_size=size).collect()
        assert sorted(((r.term, r.doc_id, r.tf) for r in got), key=repr) == sorted(((t, d, want.get((t, d))) for t, d in pairs), key=repr)
