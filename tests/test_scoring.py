import random

import pytest
from pyspark.sql import functions as F

from ranklight.operators import indexing, ranking, scoring


def _tables(spark, ids="bigint"):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(["all", *(words[min(39, int(rng.expovariate(0.15)))] for _ in range(rng.randint(0, 12)))])) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(300, 330)] + [(None, "w1 w2"), (3, "w9 w9"), (400, None)]
    queries = [(str(i), t) for i, (_, t) in enumerate(docs[:60])] + [("same", "w1"), ("same", "w2 w2"), (None, "w3"), ("zero", "all"), ("none", "moon"),
                                                                     ("faint", "all w39")]
    return (spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(ids)),
            spark.createDataFrame(queries, "query_id string, text string"))


@pytest.mark.parametrize("method", ["cosine", "bm25"])
@pytest.mark.parametrize("ids", ["bigint", "string"])
def test_scores_added_up_in_parts_equal_the_join(spark, monkeypatch, method, ids):
    docs, queries = _tables(spark, ids)
    index = indexing.build_index(docs, stopwords=())
    find = ranking.cosine_search if method == "cosine" else ranking.bm25_search
    want = {(r.query_id, r.rank): (r.doc_id, round(r.score, 7)) for r in find(index, queries, 10).collect()}
    for part_docs, dense in ((scoring.PART_DOCS, scoring.DENSE_BYTES), (50, 0), (50, 4000)):
        monkeypatch.setattr(scoring, "PART_DOCS", part_docs)
        monkeypatch.setattr(scoring, "DENSE_BYTES", dense)
        got = find(index, queries, 10, max_pairs=0)
        assert got.columns == list(ranking.HIT_COLS)
        assert {(r.query_id, r.rank): (r.doc_id, round(r.score, 7)) for r in got.collect()} == want


def test_a_large_batch_has_no_row_for_each_pair(spark):
    docs, queries = _tables(spark)
    plan = ranking.cosine_search(indexing.build_index(docs, stopwords=()), queries, 10, max_pairs=0)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(query_id" in x and "doc_id" in x]


def test_queries_travel_in_blobs(spark, monkeypatch):
    rows = [(f"q{i % 300}", f"w{i}", 1.0 / (i + 1), 1) for i in range(3000)]
    queries = spark.createDataFrame(rows, "query_id string, term string, weight double, df bigint")
    weights = spark.createDataFrame([(f"w{i}", i % 50, 0.5) for i in range(3000)], "term string, doc_id bigint, weight double")
    written, save = [], scoring.materialize
    monkeypatch.setattr(scoring, "materialize", lambda df, name, *a: written.append(out := save(df, name, *a)) or out)
    assert scoring.best(queries, weights, 50, 3).count() == 300
    blobs = [w for w in written if "blob" in w.columns]
    assert len(blobs) == 1 and blobs[0].count() <= 8  # of 3000 terms, which were a row each in every part
