from pyspark.sql.classic.dataframe import DataFrame

from ranklight.operators import lookup


def test_a_block_is_joined_once_for_its_pairs(spark, monkeypatch):
    postings = spark.createDataFrame([(t, d, d % 5 + 1) for t, step in (("a", 1), ("b", 3), ("c", 50)) for d in range(0, 300, step)],
                                     "term string, doc_id bigint, tf bigint")
    pairs = [(t, d) for t in ("a", "b", "c", "none") for d in range(-1, 302)] * 2
    index = lookup.build(postings, block_size=128, fan=2)
    read, map_in_arrow = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, *a, **k: read.append(self) or map_in_arrow(self, *a, **k))
    got = lookup.lookup(index, spark.createDataFrame(pairs, "term string, doc_id bigint"), block_size=128).collect()
    held = {(r.term, r.doc_id): r.tf for r in postings.collect()}
    assert sorted((r.term, r.doc_id, r.tf or 0) for r in got) == sorted((t, d, held.get((t, d), 0)) for t, d in pairs)
    # 3 + 1 + 1 blocks, visited by at most 256, 256, 88 pairs of "a", some 600 of "b" and 502 of "c": not one row a pair
    assert len(read) == 1 and read[0].count() <= 16


def test_pairs_move_once(spark):
    postings = spark.createDataFrame([(f"t{d % 7}", d, 1) for d in range(200)], "term string, doc_id bigint, tf bigint")
    index = lookup.build(postings, block_size=8, fan=2)
    pairs = spark.createDataFrame([("t1", d) for d in range(200)], "term string, doc_id bigint")
    plan = lookup.lookup(index, pairs, block_size=8)._jdf.queryExecution().executedPlan().toString()
    # the pairs to their blocks, the blocks to their pairs, and the directory's groups, which are broadcast then
    assert plan.count("Exchange hashpartitioning") <= 3, plan


def test_a_null_document_hides_no_posting_of_its_block(spark):
    postings = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("a", 5, 1)], "term string, doc_id bigint, tf bigint")
    pairs = spark.createDataFrame([("a", 3), ("a", 4), ("a", None)], "term string, doc_id bigint")
    got = lookup.lookup(lookup.build(postings), pairs).collect()
    assert sorted((r.doc_id or 0, r.tf) for r in got if r.tf) == [(3, 2)] and len(got) == 3
