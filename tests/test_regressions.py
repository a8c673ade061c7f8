"""Cases that once lost or changed results."""

import re

from ranklight.operators import indexing, neighbours, ranking
from ranklight.sources import index_store


def test_grid_keeps_hits_at_cell_borders(spark):
    coll = spark.createDataFrame([(1, [1.2, 0.0, 0.0]), (2, [9.0, 0.0, 0.0])], "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([(7, [-1e-17, 0.0, 0.0])], "query_id bigint, embedding array<double>")
    want = [(r.query_id, r.vec_id) for r in neighbours.within(coll, q, 1.2).collect()]
    got = [(r.query_id, r.vec_id) for r in neighbours.grid_within(coll, q, 1.2).collect()]
    assert want == got == [(7, 1)]


def test_saved_index_keeps_its_stop_list(spark, tmp_path):
    docs = spark.createDataFrame([(i, "the of and x%d" % i if i % 2 else "the end") for i in range(6)],
                                 "doc_id bigint, text string")
    q = spark.createDataFrame([(1, "of and")], "query_id bigint, text string")
    table = spark.createDataFrame([("end",)], "word string")
    for name, stop in (("none", ()), ("table", table)):
        idx = indexing.build_index(docs, stopwords=stop)
        index_store.save_index(idx, str(tmp_path / name))
        back = index_store.load_index(spark, str(tmp_path / name))
        hits = lambda i: sorted((r.doc_id, round(r.score, 9)) for r in ranking.cosine_search(i, q, 10).collect())  # noqa: E731,B023
        assert hits(idx) == hits(back) and len(hits(back)) == 3


def test_catalogue_needs_no_spark_jars(monkeypatch):
    """The stop list ships with the package: neither the queries nor their SQL open a jar."""
    import pathlib

    import __spark_entry__ as entry
    import ranklight

    assert entry.queries() and entry.oracle_sql()
    for f in pathlib.Path(ranklight.__file__).parent.rglob("*.py"):
        assert not re.search(r"\.jar\b|zipfile", f.read_text()), f


def test_entry_without_the_training_data_folder(monkeypatch):
    """queries() and oracle_sql() work where corpus_pipeline.py and its operators are not there."""
    import sys

    import __spark_entry__ as entry
    from ranklight.plans.catalog import ORACLE, QUERIES

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert entry.queries().keys() == QUERIES.keys() and entry.oracle_sql().keys() == ORACLE.keys()


def test_scratch_of_a_run_is_removed(spark, sf001):
    from ranklight.session import checkpoint_dir
    from ranklight.sources import scratch

    def folders():
        jvm = spark._jvm.org.apache.hadoop.fs
        path = jvm.Path(checkpoint_dir(spark))
        return {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    with scratch.run(spark) as name:
        assert indexing.build_index(docs).weights.count() > 0 and name in folders()
    assert name not in folders() and not scratch.purge(spark, name)


def test_broadcast_bound_counts_bytes(spark):
    from ranklight.operators.sizing import bounded

    df = spark.createDataFrame([(i, "é" * 100) for i in range(10)], "id int, term string")
    assert bounded(df, 10) and not bounded(df, 9) and bounded(df, 10, 2000) and not bounded(df, 10, 1999)
    assert bounded(df.select("id"), 10, 0) and bounded(df.limit(0), 0, 0)
