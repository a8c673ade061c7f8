"""Table utility and source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ranklight.operators import indexing, tables
from ranklight.operators.sweep import write_prefixes
from ranklight.plans import duck
from ranklight.plans.catalog import r6, register, table
from ranklight.session import checkpoint_dir
from ranklight.sources import files


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/ranklight/{name}-{uuid.uuid4().hex}"


@register("p4_ordinals_lineitem",
          "SELECT l_orderkey, l_linenumber, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1)::BIGINT AS ordinal FROM lineitem")
def p4_ordinals_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return tables.with_ordinal(li, ["l_orderkey", "l_linenumber"])


@register("p4_ordinals_per_user",
          "SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS ordinal FROM events")
def p4_ordinals_per_user(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return tables.with_ordinal(ev, ["ts", "event_id"], ["user_id"]).select("user_id", "event_id", "ordinal")


@register("p2_leading_columns", "SELECT c_custkey, c_name FROM customer")
def p2_leading_columns(spark, sf_dir):
    return tables.leading_columns(table(spark, sf_dir, "customer"), 2)


@register("p3_drop_column", "SELECT doc_id, lang, source, n_chars FROM documents")
def p3_drop_column(spark, sf_dir):
    return table(spark, sf_dir, "documents").drop("text")


@register("p7_length_filter_kept",
          "SELECT doc_id, round(n_chars / 60.0, 6) AS minutes FROM documents WHERE n_chars / 60.0 <= 6")
def p7_length_filter_kept(spark, sf_dir):
    kept, _ = tables.length_filter(table(spark, sf_dir, "documents"), "n_chars", 6)
    return kept.select("doc_id", r6(F.col("n_chars") / 60.0).alias("minutes"))


@register("p7_length_outliers",
          "SELECT doc_id, round(n_chars / 60.0, 6) AS minutes FROM documents WHERE n_chars / 60.0 > 50")
def p7_length_outliers(spark, sf_dir):
    _, over = tables.length_filter(table(spark, sf_dir, "documents"), "n_chars", 50)
    return over.select("doc_id", r6(F.col("n_chars") / 60.0).alias("minutes"))


@register("p8_middle_slice",
          "WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, count(*) OVER () AS n FROM orders) "
          "SELECT o_orderkey, ordinal::BIGINT AS ordinal FROM o WHERE ordinal >= n // 4 AND ordinal < n // 2")
def p8_middle_slice(spark, sf_dir):
    """``df[a:b]`` with a, b at a quarter and a half of the table."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    n = o.select(F.count(F.lit(1))).scalar()
    oo = tables.with_ordinal(o, ["o_orderkey"])
    return oo.filter((F.col("ordinal") >= F.floor(n / 4)) & (F.col("ordinal") < F.floor(n / 2)))


@register("a10_table_shape",
          "SELECT 'lineitem' AS tbl, count(*)::BIGINT AS rows, (count(*) * 11)::BIGINT AS cells FROM lineitem "
          "UNION ALL SELECT 'documents', count(*)::BIGINT, (count(*) * 5)::BIGINT FROM documents")
def a10_table_shape(spark, sf_dir):
    li, docs = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "documents")
    return (tables.shape(li).select(F.lit("lineitem").alias("tbl"), "rows", "cells")
            .unionByName(tables.shape(docs).select(F.lit("documents").alias("tbl"), "rows", "cells")))


@register("f14_f16_f18_labels",
          "SELECT doc_id, concat_ws(' - ', doc_id::VARCHAR, lang, source) AS label, "
          "printf('%.4f', n_chars / 1000.0) AS kchars, doc_id::VARCHAR::BIGINT AS id_back FROM documents")
def f14_f16_f18_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tables.label(F.col("doc_id").cast("string"), "lang", "source").alias("label"),
                    tables.fixed4(F.col("n_chars") / 1000.0).alias("kchars"),
                    tables.to_long(F.col("doc_id").cast("string")).alias("id_back"))


@register("s1_csv_corpus_roundtrip", "SELECT doc_id, lang, n_chars, length(text)::BIGINT AS text_len, md5(text) AS text_md5 FROM documents")
def s1_csv_corpus_roundtrip(spark, sf_dir):
    """Write the corpus as CSV (multi-line quoted text) and read it back."""
    path = _scratch(spark, "corpus-csv")
    files.write_corpus_csv(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text"), path)
    back = files.read_corpus_csv(spark, path, "doc_id bigint, lang string, n_chars bigint, text string")
    return back.select("doc_id", "lang", "n_chars", F.length("text").cast("bigint").alias("text_len"),
                       F.md5("text").alias("text_md5"))


@register("s2_split_csv", "SELECT doc_id, lang, n_chars, length(text)::BIGINT AS text_len, md5(text) AS text_md5 FROM documents")
def s2_split_csv(spark, sf_dir):
    """The corpus as one CSV file with multi-line quoted text (several beyond ``FILE_BYTES``), read by byte ranges."""
    path = _scratch(spark, "corpus-one-csv")
    files.write_corpus_csv(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text"), path, files.FILE_BYTES)
    back = files.read_corpus_csv_split(spark, path, "doc_id bigint, lang string, n_chars bigint, text string")
    return back.select("doc_id", "lang", "n_chars", F.length("text").cast("bigint").alias("text_len"),
                       F.md5("text").alias("text_md5"))


@register("s6_feature_csv_roundtrip",
          "SELECT format('{:d} - label {:d}', vec_id, label) AS filename, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, "
          "round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings")
def s6_feature_csv_roundtrip(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("name", F.format_string("%d - label %d", "vec_id", "label"))
    path = _scratch(spark, "features-csv")
    files.save_features(e, "embedding", "name", path, 64)
    back = files.load_features(spark, path, 64)
    return back.select("filename", F.posexplode("features").alias("pos", "value")).select(
        "filename", "pos", r6("value").alias("value"))


@register("s7_suffix_listing", "SELECT page_id, url FROM pages WHERE regexp_replace(url, '[?#].*$', '') LIKE '%.html'")
def s7_suffix_listing(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.filter(files.has_suffix("url", ".html")).select("page_id", "url")


@register("s8_stoplist_file_index", f"WITH {duck.index_ctes()} SELECT term, df FROM vocab")
def s8_stoplist_file_index(spark, sf_dir):
    """The stop list read from a text file as a table (left-anti join path) gives the same index."""
    from ranklight.functions.text import default_stopwords

    path = _scratch(spark, "stoplist")
    lines = [w.upper() + "  " for w in default_stopwords("english")]  # case and trailing blanks are normalised
    spark.createDataFrame([(w,) for w in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    sw = files.read_stoplist(spark, path)
    idx = indexing.build_index(table(spark, sf_dir, "documents"), stopwords=sw)
    return idx.vocab.select("term", "df")


@register("s10_prefix_tables",
          "WITH o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents), "
          "sizes AS (SELECT DISTINCT ceil(n / power(2, i))::BIGINT AS n FROM (SELECT count(*) AS n FROM documents), range(0, 6) t(i)) "
          "SELECT s.n, count(*)::BIGINT AS rows, sum(o.n_chars)::BIGINT AS chars, max(o.doc_id) AS last_doc "
          "FROM o JOIN sizes s ON o.ordinal < s.n GROUP BY s.n")
def s10_prefix_tables(spark, sf_dir):
    """The first n rows for every size n written in one pass (partitioned by n), then read back."""
    path = _scratch(spark, "prefixes")
    write_prefixes(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"], path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("n").cast("bigint").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").cast("bigint").alias("chars"), F.max("doc_id").alias("last_doc"))
