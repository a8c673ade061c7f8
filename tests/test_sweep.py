from ranklight.operators import sweep


def test_postings_of_the_sweep_move_once(spark):
    docs = spark.createDataFrame([(i, f"alpha w{i % 7} w{i % 5} tail{i}") for i in range(90)] + [(3, "w1 again"), (200, None)], "doc_id bigint, text string")
    queries = spark.createDataFrame([(1, "w1 w2 alpha"), (2, "tail4 w3 w3"), (3, None)], "query_id bigint, text string")
    out = sweep.prefix_sweep(docs, queries, k=3, levels=3, stopwords=())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(doc_id" in x or "Exchange hashpartitioning(term" in x and "tf#" in x], plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(query_id" in x and "doc_id" in x], plan
    rows = out.collect()
    assert {r.n for r in rows} == {92, 46, 23} and all(r.rank <= 3 for r in rows)
    assert [r.doc_id for r in rows if (r.n, r.query_id, r.rank) == (92, 2, 1)] == [4]
