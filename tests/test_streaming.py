from ranklight.operators import indexing, ranking
from ranklight.sources import index_store
from ranklight.streaming import start_search_stream


def test_stream_answers_like_batch(spark, tmp_path, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    index_store.save_index(indexing.build_index(docs), str(tmp_path / "idx"), buckets=8)
    idx = index_store.load_index(spark, str(tmp_path / "idx"))
    bench.repartition(3).write.parquet(str(tmp_path / "queries"))
    q = start_search_stream(spark, idx, str(tmp_path / "queries"), str(tmp_path / "hits"), str(tmp_path / "ckpt"), k=5)
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "hits")).select("query_id", "rank", "doc_id")
    want = ranking.cosine_search(idx, bench, 5).select("query_id", "rank", "doc_id")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
