"""Growing store: equal to a rebuild after appends, replacements and merges; safe against failures and other writers."""

import pytest
from pyspark.sql import functions as F

from ranklight.operators import indexing, ranking
from ranklight.sources import index_store, manifest, segments

DOCS = "doc_id bigint, text string"


def rows(df):
    return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 8)) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark, sf001):
    return spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def queries(spark, sf001):
    return spark.read.parquet(f"{sf001}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text").limit(12)


@pytest.fixture(scope="module")
def grown(spark, corpus, tmp_path_factory):
    """Three appends; the first holds stale texts of some documents, which the last replaces."""
    path = str(tmp_path_factory.mktemp("seg") / "s")
    stale = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("stale words "), F.substring("text", 1, 200))).otherwise(F.col("text"))
    now = segments.create(spark, path, buckets=4)
    now = segments.append(now, corpus.filter("doc_id % 3 <> 1").withColumn("text", stale))
    old = segments.append(now, corpus.filter("doc_id % 3 = 1 AND doc_id % 2 = 0"))
    now = segments.append(old, corpus.filter("(doc_id % 3 = 1 AND doc_id % 2 = 1) OR (doc_id % 3 <> 1 AND doc_id % 5 = 0)"))
    return path, old, now


def same_as_rebuild(now, corpus, queries):
    full = indexing.build_index(corpus)
    for method in ("cosine", "bm25"):
        assert rows(segments.search(now, queries, 10, method)) == rows(ranking.search(full, queries, 10, method))
    want = {r.doc_id: r.norm for r in full.norms.collect()}
    got = {r.doc_id: r.norm for r in now.norms.collect()}
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-9, abs=1e-9) for d in want)
    assert sorted(map(tuple, now.vocab.select("term", "df", "cf").collect())) == sorted(map(tuple, full.vocab.select("term", "df", "cf").collect()))
    assert now.state.n_docs == corpus.count() == now.documents.agg(F.sum("copies")).first()[0]


def test_appends_equal_a_rebuild(grown, corpus, queries):
    same_as_rebuild(grown[2], corpus, queries)
    assert len(grown[2].state.segments) == 3 and grown[2].state.gone


def test_merge_rewrites_small_segments_only(spark, grown, corpus, queries):
    path, _, now = grown
    clean = segments.append(segments.merge(now, 10 ** 9), spark.createDataFrame([(10 ** 6, "one more")], DOCS))
    clean = segments.append(clean, spark.createDataFrame([(10 ** 6 + 1, "and another")], DOCS))
    large = clean.state.segments[0]
    merged = segments.merge(clean, 10)
    assert [s.folder for s in merged.state.segments][0] == large.folder and len(merged.state.segments) == 2
    both = corpus.unionAll(spark.createDataFrame([(10 ** 6, "one more"), (10 ** 6 + 1, "and another")], DOCS))
    same_as_rebuild(merged, both, queries)
    assert segments.merge(merged, 0) is merged


def test_old_snapshot_is_not_disturbed(spark, grown, queries, corpus):
    path, old, _ = grown
    stale = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("stale words "), F.substring("text", 1, 200))).otherwise(F.col("text"))
    then = corpus.filter("doc_id % 3 <> 1").withColumn("text", stale).unionAll(corpus.filter("doc_id % 3 = 1 AND doc_id % 2 = 0"))
    same_as_rebuild(old, then, queries)
    assert old.state.version < segments.open_store(spark, path).state.version


def test_failure_and_conflict(spark, tmp_path, monkeypatch):
    docs = lambda *t: spark.createDataFrame(list(t), DOCS)
    path = str(tmp_path / "s")
    first = segments.append(segments.create(spark, path, stopwords=()), docs((1, "red green"), (2, "red")))
    q = spark.createDataFrame([(0, "green")], "query_id bigint, text string")
    before = rows(segments.search(segments.open_store(spark, path), q))

    def broken(*a, **k):
        raise OSError("disk is full")

    monkeypatch.setattr(segments.manifest, "commit", broken)
    with pytest.raises(OSError):
        segments.append(first, docs((3, "green green")))
    monkeypatch.undo()
    now = segments.open_store(spark, path)
    assert now.state.version == first.state.version and rows(segments.search(now, q)) == before
    second = segments.append(first, docs((3, "green")))
    with pytest.raises(manifest.Conflict):
        segments.append(first, docs((4, "green")))
    now = segments.open_store(spark, path)
    assert now.state.version == second.state.version and now.state.n_docs == 3
    left = len(segments.drop_unused(now))
    assert left >= 1 and {r.doc_id for r in segments.search(now, q).collect()} == {1, 3}


def test_edges(spark, tmp_path):
    """Terms in every document (norm zero), empty and null texts, repeated ids, documents that lose all their words."""
    docs = [(1, "all one"), (2, "all two"), (3, ""), (4, None), (5, "all"), (5, "all"), (6, "all three three")]
    store = segments.create(spark, str(tmp_path / "s"), stopwords=())
    assert segments.search(store, spark.createDataFrame([(0, "all")], "query_id bigint, text string")).count() == 0
    store = segments.append(store, spark.createDataFrame(docs[:3], DOCS))
    store = segments.append(store, spark.createDataFrame(docs[3:], DOCS))
    q = spark.createDataFrame([(0, "all"), (1, "three one"), (2, ""), (3, None)], "query_id bigint, text string")
    for now, then in ((store, docs), (segments.append(store, spark.createDataFrame([(1, ""), (3, "all two")], DOCS)),
                                      [d for d in docs if d[0] not in (1, 3)] + [(1, ""), (3, "all two")])):
        full = indexing.build_index(spark.createDataFrame(then, DOCS), stopwords=())
        for method in ("cosine", "bm25"):
            assert rows(segments.search(now, q, 20, method)) == rows(ranking.search(full, q, 20, method))
    flat = segments.append(segments.create(spark, str(tmp_path / "f"), stopwords=()), spark.createDataFrame([(i, "same") for i in range(9)], DOCS))
    assert {r.norm for r in flat.norms.collect()} == {0.0} and segments.search(flat, q.limit(1)).count() == 0


def test_replaced_index_keeps_its_readers(spark, corpus, queries, tmp_path):
    path = str(tmp_path / "i")
    old = index_store.replace_collection(corpus.filter("doc_id % 2 = 0"), path)
    want = rows(ranking.cosine_search(old, queries))
    new = index_store.replace_collection(corpus, path)
    assert rows(ranking.cosine_search(old, queries)) == want != rows(ranking.cosine_search(new, queries))
    assert new.extra["version"] == old.extra["version"] + 1
    assert len(index_store.drop_old_versions(spark, path)) == 1
    assert rows(ranking.cosine_search(index_store.load_index(spark, path), queries)) == rows(ranking.cosine_search(new, queries))


def test_wrong_bucket_declaration_is_replaced(spark, corpus, queries, tmp_path):
    path = str(tmp_path / "i")
    idx = index_store.replace_collection(corpus, path, buckets=4)
    want = rows(ranking.cosine_search(idx, queries))
    folder = manifest.latest(spark, path)["folder"]
    name = index_store._table_name("weights", folder)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({index_store.WEIGHTS}) USING parquet CLUSTERED BY (doc_id) SORTED BY (term, doc_id) INTO 16 BUCKETS "
              f"LOCATION '{folder}/weights'")
    assert rows(ranking.cosine_search(index_store.load_index(spark, path), queries)) == want


def test_texts_of_an_append_are_analysed_once(spark):
    """Below the exchange nothing is analysed; words are counted in their own row, rows of one id together."""
    texts = ["red fox cannot can red", "red", None, "", "... --", "gonna go, go", "the fox"]
    docs = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)], DOCS)
    moved = docs.repartition(3, "doc_id")
    for stop in ((), ("the", "can")):
        tf = indexing.term_frequencies(docs, stopwords=stop)
        want = tf.join(tf.groupBy("doc_id").agg(F.sum("tf").alias("dl")), "doc_id").select("term", "doc_id", "tf", "dl")
        got = indexing.document_postings(moved, stop, repeated=True)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    single = docs.limit(5)
    tf = indexing.term_frequencies(single, stopwords=())
    once = indexing.document_postings(single.repartition(3, "doc_id"), (), repeated=False)
    assert sorted((r.term, r.doc_id, r.tf) for r in once.collect()) == sorted((r.term, r.doc_id, r.tf) for r in tf.collect())
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "lower" not in plan[plan.index("RepartitionByExpression"):]


def test_statistics_where_the_counts_exceed_a_broadcast(spark, corpus, tmp_path, monkeypatch):
    """Postings are not shuffled by term where counts can be broadcast; beyond that only those of rare terms are."""
    counts = spark.createDataFrame([("a", 9), ("b", 4), ("c", 1)], "term string, top bigint")
    postings = spark.createDataFrame([(t, d) for d in range(3) for t in "abcd"], "term string, doc_id bigint")
    want = sorted((t, d, {"a": 9, "b": 4, "c": 1}.get(t) or 0) for d in range(3) for t in "abcd")
    for max_rows in (9, 2, 1, 0):
        got = segments._with_counts(postings, counts, max_rows, 1 << 20)
        assert sorted((r.term, r.doc_id, r.top or 0) for r in got.collect()) == want
        assert ("RightOuter" in got._jdf.queryExecution().optimizedPlan().toString() or "LeftOuter" in got._jdf.queryExecution().optimizedPlan().toString())
    few = corpus.limit(60)
    full = {r.doc_id: r.norm for r in indexing.build_index(few).norms.collect()}
    for rows, hot in ((20, 64 << 20), (2_000_000, 10)):  # rare terms by a shuffle; an id with more text than one task should analyse
        monkeypatch.setattr(segments, "MAX_BROADCAST_ROWS", rows)
        monkeypatch.setattr(indexing, "HOT_BYTES", hot)
        store = segments.create(spark, str(tmp_path / f"s{rows}"), buckets=3)
        store = segments.append(segments.append(store, few.filter("doc_id % 2 = 0")), few.filter("doc_id % 2 = 1 OR doc_id % 3 = 0"))
        got = {r.doc_id: r.norm for r in store.norms.collect()}
        assert got.keys() == full.keys() and all(got[d] == pytest.approx(full[d], rel=1e-9, abs=1e-9) for d in full)
