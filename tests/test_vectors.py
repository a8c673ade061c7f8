import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import neighbours


def _coll(spark, pts):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id bigint, embedding array<double>")


def _q(spark, v):
    return spark.createDataFrame([(0, [float(x) for x in v])], "query_id bigint, embedding array<double>")


def test_g3_knn_and_tie(spark):
    c = _coll(spark, [(1, 4, 7), (2, 5, 8), (3, 6, 9)])
    one = [(0, [2.0, 5.0, 8.0])]
    for hits in (neighbours.knn(c, _q(spark, (2, 5, 8)), 2), neighbours.knn(c, _q(spark, (2, 5, 8)), 2, block_rows=2),
                 neighbours.knn_of(c, one, 2)):  # parts, blocked, literal
        r = hits.orderBy("rank").collect()
        assert [x.vec_id for x in r] == [1, 0]
        assert r[1].dist == pytest.approx(math.sqrt(3))


def test_g3_range(spark):
    c = _coll(spark, [(1, 4, 7), (2, 5, 8), (3, 6, 9)])
    assert neighbours.within(c, _q(spark, (2, 5, 8)), 1.8).count() == 3
    assert neighbours.within(c, _q(spark, (2, 5, 8)), 1.7).count() == 1


def test_g4_metrics(spark):
    c = _coll(spark, [(0, 0), (3, 4), (1, 1)])
    l2 = neighbours.order_hits(neighbours.within(c, _q(spark, (0, 0)), 5.0, "l2")).collect()
    assert [r.vec_id for r in l2] == [0, 2, 1]
    sq = neighbours.order_hits(neighbours.within(c, _q(spark, (0, 0)), 5.0, "sqeuclidean")).collect()
    assert [r.vec_id for r in sq] == [0, 2]


def test_k_larger_than_collection_and_zero(spark):
    c = _coll(spark, [(0, 0), (3, 4)])
    assert neighbours.knn(c, _q(spark, (0, 0)), 10).count() == 2
    assert neighbours.knn(c, _q(spark, (0, 0)), 0).count() == 0


def test_dimension_mismatch_raises(spark):
    c = _coll(spark, [(0, 0, 0), (3, 4, 5)])
    with pytest.raises(Exception):
        neighbours.knn(c, _q(spark, (0, 0)), 1).collect()


@pytest.fixture(scope="module")
def emb(spark, sf001):
    return spark.read.parquet(f"{sf001}/embeddings.parquet")


def _set(df, cols=("query_id", "vec_id")):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_grid_equals_exact_range(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    assert _set(neighbours.grid_within(emb, q, 1.2, block_rows=64)) == _set(neighbours.within(emb, q, 1.2))


def test_squared_radius_equals_l2_radius(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    assert _set(neighbours.within(emb, q, 1.44, "sqeuclidean")) == _set(neighbours.within(emb, q, 1.2, "l2"))


def test_squared_knn_same_order_as_l2(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    a = _set(neighbours.knn(emb, q, 5, "l2"), ("query_id", "rank", "vec_id"))
    b = _set(neighbours.knn(emb, q, 5, "sqeuclidean"), ("query_id", "rank", "vec_id"))
    assert a == b


def test_blocked_equals_broadcast(spark, emb, monkeypatch):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    a = _set(neighbours.knn(emb, q, 5), ("query_id", "rank", "vec_id"))
    assert a == _set(neighbours.knn(emb, q, 5, block_rows=50), ("query_id", "rank", "vec_id"))
    literal = [(r.query_id, r.embedding) for r in q.collect()]
    assert a == _set(neighbours.knn_of(emb, literal, 5), ("query_id", "rank", "vec_id"))
    assert _set(neighbours.within_of(emb, literal, 1.2)) == _set(neighbours.within(emb, q, 1.2))
    monkeypatch.setattr(neighbours, "PACK_ROWS", 16)  # many blobs, many parts
    monkeypatch.setattr(neighbours, "PART_BLOBS", 2)
    assert a == _set(neighbours.knn(emb.repartition(3), q.repartition(2), 5), ("query_id", "rank", "vec_id"))


def test_no_query_passes_through_the_driver(spark, emb, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(self, *a):
        raise AssertionError("rows were fetched")

    for name in ("collect", "take", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refused)
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    neighbours.knn(emb, q, 5), neighbours.within(emb, q, 1.2)


@pytest.mark.parametrize("scale", [1.0, 20.0, 0.01])
def test_lsh_recall_with_defaults(spark, emb, scale):
    e = emb.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("embedding"))
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    exact = _set(neighbours.knn(e, q, 5))
    hits = neighbours.lsh_knn(e, q, 5).collect()
    true = {(r.query_id, r.vec_id): r.dist for r in neighbours.within(e, q, 10.0 * scale).collect()}
    assert all(abs(true[r.query_id, r.vec_id] - r.dist) < 1e-9 * max(1, scale) for r in hits)  # candidates are ranked exactly
    assert len(hits) == 5 * q.count() and {r.rank for r in hits} == {1, 2, 3, 4, 5}
    assert len(exact & {(r.query_id, r.vec_id) for r in hits}) / len(exact) >= 0.9


def test_lsh_on_clusters_is_not_completed_for_most(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 8
    c = _coll(spark, [centres[i % 20] + rng.normal(size=16) * 0.4 for i in range(600)] + [centres[0] + 300])
    q = c.select(F.col("vec_id").alias("query_id"), "embedding")
    report = {}
    hits = neighbours.lsh_knn(c, q, 4, report=report)
    exact = _set(neighbours.knn(c, q, 4))
    assert len(exact & _set(hits)) / len(exact) >= 0.9 and hits.count() == 4 * 601
    assert 1 <= report["completed"] < 0.5 * report["queries"]
    assert neighbours.lsh_knn(c.limit(3), q, 9).count() == 3 * 601 and neighbours.lsh_knn(c, q, 0).count() == 0


def test_exact_plan_has_no_cartesian(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    for df in (neighbours.knn(emb, q, 5), neighbours.knn(emb, q, 5, block_rows=128)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_vector_search_by_flag_and_names(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    names = emb.select("vec_id", F.format_string("%d - label %d", "vec_id", "label").alias("name"))
    ranged = neighbours.vector_search(emb, q, radius=1.2, is_knn=False, method="grid", names=names)
    assert _set(ranged) == _set(neighbours.within(emb, q, 1.2))
    row = ranged.first()
    assert row.path == "media/" + row.name
    with pytest.raises(ValueError):
        neighbours.vector_search(emb, q, method="nope")


def test_hits_are_named_where_they_are_found(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    names = emb.select("vec_id", F.when(F.col("vec_id") % 7 > 0, F.format_string("v%d", "vec_id")).alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table of names beyond Spark's own limit
    try:
        named = neighbours.vector_search(emb, q, radius=1.2, is_knn=False, names=names)
        plan = named._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        apart = neighbours.vector_search(emb, q, radius=1.2, is_knn=False, names=names, max_broadcast_rows=10)
        assert "SortMergeJoin" in apart._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(tuple, named.select("query_id", "vec_id", "dist", F.coalesce("name", F.lit("")), "path").collect()))
        assert rows == sorted(map(tuple, apart.select("query_id", "vec_id", "dist", F.coalesce("name", F.lit("")), "path").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r[4] for r in rows if r[1] % 7 == 0} == {"media"} and len(rows) == neighbours.within(emb, q, 1.2).count()


def test_each_part_meets_its_queries_in_a_task_of_its_own(spark, emb, monkeypatch):
    monkeypatch.setattr(neighbours, "PACK_ROWS", 16)
    monkeypatch.setattr(neighbours, "PART_BLOBS", 2)
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    pairs = neighbours.within(emb, q, 1e9)
    held = {frozenset(r["ids"]) for r in pairs.groupBy(F.spark_partition_id()).agg(F.collect_set("vec_id").alias("ids")).collect()}
    assert sum(map(len, held)) == emb.count() and len(held) > 1  # a task holds whole parts
    assert "hashpartitioning(part" not in pairs._jdf.queryExecution().executedPlan().toString()  # which would put two into one
    assert pairs.count() == emb.count() ** 2


def test_float32_narrowing(spark):
    from ranklight.functions.vectors import to_float32

    df = spark.createDataFrame([([0.1, 0.2],)], "v array<double>")
    assert df.select(to_float32(F.col("v")).alias("f")).schema["f"].dataType.simpleString() == "array<float>"


def test_grid_on_principal_axes_equals_exact(spark, emb):
    q = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    assert _set(neighbours.grid_within(emb, q, 1.2, axes="pca", block_rows=64)) == _set(neighbours.within(emb, q, 1.2))
    assert _set(neighbours.grid_within(emb, q, 1.3, "sqeuclidean", axes="pca")) == \
        _set(neighbours.within(emb, q, 1.3, "sqeuclidean"))


def _small_vectors(spark, n=120):
    rng = np.random.default_rng(4)
    return spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(n)], "vec_id bigint, embedding array<double>")


def test_vectors_move_once_to_their_cells(spark):
    coll = _small_vectors(spark)
    qs = coll.select(F.col("vec_id").alias("query_id"), "embedding")
    for axes in ("coordinates", "pca"):
        plan = neighbours.grid_within(coll, qs, 0.8, axes=axes)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan


def test_the_hits_of_a_vector_stand_together(spark):
    coll = _small_vectors(spark).coalesce(1)
    qs = coll.select(F.col("vec_id").alias("query_id"), "embedding")
    rows = neighbours.within(coll, qs, 100.0).collect()
    assert len(rows) == 120 * 120
    assert sum(a.vec_id != b.vec_id for a, b in zip(rows, rows[1:])) < 120 * 4


def test_packed_vectors_keep_every_bit(spark):
    exact = [[0.1, 1e300], [float("nan"), 1.0], [0.5, None], [0.25, 2.0], [1e-50, -0.0]]
    for v in exact:
        df = spark.createDataFrame([(1, v)], "vec_id bigint, cv array<double>")
        blob = neighbours._packed(df, "packed-test").first().blob
        ids, back = neighbours._opened(bytes(blob))
        assert ids.tolist() == [1] and np.array_equal(back[0], np.array(v, dtype=float), equal_nan=True)
