import glob

from pyspark.sql import functions as F

from ranklight.operators import indexing
from ranklight.sources import index_store

TEXTS = ["red fox jumps", "red red fox", None, "", "blue whale sings a blue song", "fox", "red whale", "cannot sing 42"]


def _docs(spark):
    rows = [(i % 30 if i % 9 else None, TEXTS[i % len(TEXTS)]) for i in range(80)]  # ids repeat and are null
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def _sorted(df):
    """Rows as text; sums of doubles may differ in the last digits by their order."""
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def _rows(index):
    cols = ("term", "doc_id", "tf", "df", "w", "wn", "dl")
    entries = index.extra["impacts"].select("term", "block", "df", F.explode("entries").alias("e")).select("term", "block", "df", "e.*")
    return [_sorted(t) for t in (index.weights.select(*cols), index.norms, index.vocab.select("term", "df", "cf"), entries)]


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_postings_of_a_saved_index_move_once(spark):
    docs = _docs(spark)
    index = indexing.build_index(docs, stopwords=(), buckets=6)
    assert index.extra["buckets"] == 6
    assert _exchanges(index.postings.groupBy("doc_id").agg(F.sum("tf"))) == 0  # their buckets are known
    plain = indexing.build_index(docs, stopwords=())
    for name in ("postings", "vocab", "norms", "weights"):
        assert _sorted(getattr(index, name)) == _sorted(getattr(plain, name))


def test_saved_index_is_the_same_by_all_ways(spark, tmp_path, monkeypatch):
    docs = _docs(spark)
    first = index_store.replace_collection(docs, str(tmp_path / "a"), stopwords=(), buckets=5)
    want = _rows(first)
    assert len(want[0]) == len(want[3]) == first.weights.count() > 50
    for bucket in range(5):  # a bucket lies in one file
        assert len(glob.glob(f"{tmp_path}/a/index-*/weights/*_0000{bucket}.c*.parquet")) <= 1
    index_store.save_index(indexing.build_index(docs, stopwords=()), str(tmp_path / "b"), buckets=5)
    assert _rows(index_store.load_index(spark, str(tmp_path / "b"))) == want
    monkeypatch.setattr(indexing, "HOT_BYTES", 10)  # an id with more text than one task should analyse
    assert _rows(index_store.replace_collection(docs, str(tmp_path / "c"), stopwords=(), buckets=5)) == want
    monkeypatch.setattr(index_store, "MAX_BROADCAST_ROWS", 1)  # a vocabulary beyond a broadcast
    assert _rows(index_store.replace_collection(docs, str(tmp_path / "d"), stopwords=(), buckets=5)) == want
