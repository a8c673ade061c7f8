import math

import pytest

from ranklight.operators import indexing, ranking
from ranklight.sources import index_store

G1 = [(0, "sun sun sea"), (1, "sea sand"), (2, "sand sun"), (3, "rock")]


def _index(spark, docs=G1):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    return indexing.build_index(df, stopwords=())


def _hits(spark, idx, text, k=10, method="cosine"):
    q = spark.createDataFrame([(7, text)], "query_id bigint, text string")
    return [(r.doc_id, r.score) for r in ranking.search(idx, q, k, method=method).orderBy("rank").collect()]


def test_g1_norms(spark):
    norms = {r.doc_id: r.norm for r in _index(spark).norms.collect()}
    assert norms[0] == pytest.approx(0.493971699, abs=1e-9)
    assert norms[1] == pytest.approx(0.425720703, abs=1e-9)
    assert norms[3] == pytest.approx(0.602059991, abs=1e-9)


def test_g1_scores_and_tie_order(spark):
    h = _hits(spark, _index(spark), "sun sea")
    assert [d for d, _ in h] == [0, 1, 2]
    assert [s for _, s in h] == pytest.approx([0.991550839, 0.5, 0.5], abs=1e-9)


def test_g1_unknown_term_left_out_of_query_norm(spark):
    h = _hits(spark, _index(spark), "sun sun moon")
    assert [d for d, _ in h] == [0, 2]
    assert [s for _, s in h] == pytest.approx([0.792857272, 0.707106781], abs=1e-9)


def test_no_hit_gives_empty_result_with_schema(spark):
    idx = _index(spark)
    q = spark.createDataFrame([(7, "moon")], "query_id bigint, text string")
    out = ranking.cosine_search(idx, q, 10)
    assert out.count() == 0
    assert out.columns == ["query_id", "rank", "doc_id", "score"]


def test_g2_zero_weight_query_has_no_rows(spark):
    idx = _index(spark, [(0, "a b"), (1, "a c")])
    assert _hits(spark, idx, "a") == []


def test_k_cuts_and_k_larger_than_matches(spark):
    idx = _index(spark)
    assert len(_hits(spark, idx, "sun sea", k=1)) == 1
    assert len(_hits(spark, idx, "sun sea", k=100)) == 3


def test_self_query_scores_one(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    idx = indexing.build_index(docs)
    q = docs.select(docs.doc_id.alias("query_id"), "text")
    top = ranking.cosine_search(idx, q, 1).collect()
    scores = [r.score for r in top]
    assert all(0.0 <= s <= 1.0 + 1e-9 for s in scores)
    assert sum(1 for s in scores if math.isclose(s, 1.0, abs_tol=1e-9)) == len(scores)


def test_bm25_match_set_is_or_of_terms(spark):
    idx = _index(spark)
    assert {d for d, _ in _hits(spark, idx, "sea rock", method="bm25")} == {0, 1, 3}


def test_unknown_method_raises(spark):
    with pytest.raises(ValueError):
        _hits(spark, _index(spark), "sun", method="nope")


def test_saved_index_round_trip_and_plan(spark, tmp_path, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    idx = indexing.build_index(docs)
    index_store.save_index(idx, str(tmp_path / "idx"), buckets=16)
    loaded = index_store.load_index(spark, str(tmp_path / "idx"))
    a = sorted(map(tuple, ranking.cosine_search(idx, bench, 5).collect()))
    b = ranking.cosine_search(loaded, bench, 5)
    b.collect()
    plan = b._jdf.queryExecution().executedPlan().toString()
    b = sorted(map(tuple, b.collect()))
    assert [(x[0], x[1], x[2]) for x in a] == [(x[0], x[1], x[2]) for x in b]
    assert all(math.isclose(x[3], y[3], abs_tol=1e-9) for x, y in zip(a, b))
    # all terms of a document lie in one bucket: scores are summed where the weights are read
    assert "SelectedBucketsCount" in plan and "hashpartitioning(query_id" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(query_id" in x and "doc_id" in x]
    one = ranking.cosine_search(loaded, ranking.single_query(spark, bench.first()["text"]), 5)
    assert "In(term" in one._jdf.queryExecution().executedPlan().toString()  # the scan gets the terms


def test_merge_of_half_indexes_equals_full(spark, sf001):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    full = indexing.term_frequencies(docs).select("term", "doc_id", "tf")
    a = indexing.term_frequencies(docs.filter(F.col("doc_id") < 100)).select("term", "doc_id", "tf")
    b = indexing.term_frequencies(docs.filter(F.col("doc_id") >= 100)).select("term", "doc_id", "tf")
    merged = indexing.merge_postings(a, b)
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0


def test_batch_plan_has_no_cartesian_and_partial_topk(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    plan = ranking.cosine_search(indexing.build_index(docs), bench, 10)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_shuffle_join_fallback_equals_broadcast(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    idx = indexing.build_index(docs)
    a = ranking.cosine_search(idx, bench, 5)
    b = ranking.cosine_search(idx, bench, 5, max_broadcast_rows=0)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert a.select("query_id", "rank", "doc_id").exceptAll(b.select("query_id", "rank", "doc_id")).count() == 0
    assert a.count() == b.count()
    c = ranking.bm25_search(idx, bench, 5, max_broadcast_rows=0)
    d = ranking.bm25_search(idx, bench, 5)
    assert c.select("query_id", "rank", "doc_id").exceptAll(d.select("query_id", "rank", "doc_id")).count() == 0
