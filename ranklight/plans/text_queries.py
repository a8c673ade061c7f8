"""Text index and text search queries over ``documents`` and ``benchmark``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ranklight.operators import impacts, indexing, lookup, ranking
from ranklight.plans import duck
from ranklight.plans.catalog import K, r6, register, table
from ranklight.session import checkpoint_dir
from ranklight.sources import index_store, segments


def _index(spark, sf_dir, **settings):
    return indexing.build_index(table(spark, sf_dir, "documents"), **settings)


def _saved(spark, sf_dir, **settings):
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranklight/index-{uuid.uuid4().hex}"
    return index_store.replace_collection(table(spark, sf_dir, "documents"), path, **settings)


def _queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


IDX = duck.index_ctes()
QRY = duck.query_ctes()


@register("a1_term_frequency", f"WITH {IDX} SELECT doc_id, term, tf FROM postings")
def a1_term_frequency(spark, sf_dir):
    return _index(spark, sf_dir).postings.select("doc_id", "term", "tf")


@register("a2_document_frequency", f"WITH {IDX} SELECT term, df, cf FROM vocab")
def a2_document_frequency(spark, sf_dir):
    return _index(spark, sf_dir).vocab


@register("a3_corpus_size", "SELECT count(*)::BIGINT AS n_docs FROM documents")
def a3_corpus_size(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs"))


@register("m2_weights", f"WITH {IDX} SELECT term, doc_id, tf, df, round(w, 6) AS w FROM weights")
def m2_weights(spark, sf_dir):
    return _index(spark, sf_dir).weights.select("term", "doc_id", "tf", "df", r6("w").alias("w"))


@register("a6_norms", f"WITH {IDX} SELECT doc_id, round(norm, 6) AS norm, dl FROM norms")
def a6_norms(spark, sf_dir):
    return _index(spark, sf_dir).norms.select("doc_id", r6("norm").alias("norm"), "dl")


@register("m4_cosine_batch",
          f"WITH {IDX},\n{QRY},\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def m4_cosine_batch(spark, sf_dir):
    hits = ranking.cosine_search(_index(spark, sf_dir), _queries(spark, sf_dir), K)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


ONE_TEXT = "the attion to thanedble, anea: worthless que pathetic"


@register("m3_cosine_single",
          f"WITH {IDX},\n" + duck.query_ctes(f"(SELECT 0::BIGINT AS item_id, {duck.q(ONE_TEXT)} AS text)") +
          f",\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def m3_cosine_single(spark, sf_dir):
    """One query string against the whole corpus: the single-query API."""
    hits = ranking.cosine_search(_index(spark, sf_dir), ranking.single_query(spark, ONE_TEXT), K)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


@register("m3_saved_single",
          f"WITH {IDX},\n" + duck.query_ctes(f"(SELECT 0::BIGINT AS item_id, {duck.q(ONE_TEXT)} AS text)") +
          f",\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def m3_saved_single(spark, sf_dir):
    """One query string on a saved index, by the block-max impact table with all its pruning rounds."""
    hits = impacts.search_one(_saved(spark, sf_dir), ONE_TEXT, K, "cosine", one_pass=0)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


BM25_K1, BM25_B = 1.2, 0.75
BM25_SQL = (
    f"WITH {IDX},\n{QRY},\n"
    "avgdl AS (SELECT (SELECT sum(tf) FROM postings)::DOUBLE / n AS a FROM nd),\n"
    "bm AS (SELECT q.query_id, p.doc_id, sum(q.qtf * ln(1 + (nd.n - q.df + 0.5) / (q.df + 0.5)) * "
    f"(p.tf * {BM25_K1 + 1}) / (p.tf + {BM25_K1} * ({1 - BM25_B} + {BM25_B} * m.dl / avgdl.a))) AS score "
    "FROM qtf q JOIN postings p USING (term) JOIN norms m USING (doc_id) CROSS JOIN nd CROSS JOIN avgdl "
    "GROUP BY q.query_id, p.doc_id)\n" + duck.top_k_sql("bm", K))


@register("m5_saved_single", BM25_SQL.replace(QRY, duck.query_ctes(f"(SELECT 0::BIGINT AS item_id, {duck.q(ONE_TEXT)} AS text)")))
def m5_saved_single(spark, sf_dir):
    """The same by BM25."""
    hits = impacts.search_one(_saved(spark, sf_dir), ONE_TEXT, K, "bm25", k1=BM25_K1, b=BM25_B, one_pass=0)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


@register("m5_bm25_batch", BM25_SQL)
def m5_bm25_batch(spark, sf_dir):
    hits = ranking.bm25_search(_index(spark, sf_dir), _queries(spark, sf_dir), K, k1=BM25_K1, b=BM25_B)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


@register("m7_search_with_text",
          f"WITH {IDX},\n{QRY},\n{duck.cosine_ctes()},\nhits AS ({duck.top_k_sql('scores', K)})\n"
          "SELECT h.query_id, h.rank, h.doc_id, d.lang AS language, d.source, d.text, h.score "
          "FROM hits h JOIN documents d USING (doc_id)")
def m7_search_with_text(spark, sf_dir):
    """M7: hits with the source row's columns under result headers (one join, J3 + P1)."""
    docs = table(spark, sf_dir, "documents")
    out = ranking.search_with_documents(_index(spark, sf_dir), _queries(spark, sf_dir), docs, K, "cosine",
                                        {"lang": "language", "source": "source", "text": "text"})
    return out.withColumn("score", r6("score"))


@register("s3_saved_index_search",
          f"WITH {IDX},\n{QRY},\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def s3_saved_index_search(spark, sf_dir):
    """S3/S4/S5 round trip: build, write, reopen, search — equals m4."""
    hits = ranking.cosine_search(_saved(spark, sf_dir), _queries(spark, sf_dir), K)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


STOP = ("the", "of", "and", "de", "la")


@register("s3_saved_index_own_stoplist",
          f"WITH {duck.index_ctes(stopwords=STOP)},\n{duck.query_ctes(stopwords=STOP)},\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def s3_saved_index_own_stoplist(spark, sf_dir):
    """S3: an index saved with its own stop list; queries after the reload are analysed with that list."""
    hits = ranking.cosine_search(_saved(spark, sf_dir, stopwords=STOP), _queries(spark, sf_dir), K)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))


def _grown(spark, sf_dir):
    """A store of the whole table in three appends and a merge; the first append holds outdated texts of every fifth
    document, which the last one replaces."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranklight/store-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    own, old = F.pmod(F.xxhash64("doc_id"), F.lit(3)), F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    now = segments.append(segments.create(spark, path), docs.withColumn("text", F.when(old, F.reverse("text")).otherwise(F.col("text"))).filter(own == 0))
    now = segments.append(now, docs.filter(own == 1))
    now = segments.append(now, docs.filter((own == 2) | (own == 0) & old))
    return segments.merge(now, max_docs=0)


@register("s5_append_equals_rebuild",
          f"WITH {IDX},\n{QRY},\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def s5_append_equals_rebuild(spark, sf_dir):
    """Hits over a store grown by appends, replacements and a merge, against an index built at once."""
    return segments.search(_grown(spark, sf_dir), _queries(spark, sf_dir), K).select(
        "query_id", "rank", "doc_id", r6("score").alias("score"))


@register("a6_norms_after_appends", f"WITH {IDX} SELECT doc_id, round(norm, 6) AS norm FROM norms")
def a6_norms_after_appends(spark, sf_dir):
    """Norms from mergeable statistics after appends, replacements and a merge."""
    return _grown(spark, sf_dir).norms.select("doc_id", r6("norm").alias("norm"))


@register("s4_saved_norms", f"WITH {IDX} SELECT doc_id, round(norm, 6) AS norm, dl FROM norms")
def s4_saved_norms(spark, sf_dir):
    """Document norms and lengths read back from a saved index."""
    norms = _saved(spark, sf_dir).norms
    return norms.select("doc_id", r6("norm").alias("norm"), "dl")


@register("a4_posting_lists",
          f"WITH {IDX} SELECT term, count(*)::BIGINT AS df, min(doc_id) AS first_doc, max(doc_id) AS last_doc, "
          "arg_min(tf, doc_id) AS first_tf, sum(tf)::BIGINT AS cf FROM postings GROUP BY term")
def a4_posting_lists(spark, sf_dir):
    """A4/T4 export form in bounded blocks, checked through their first/last entries (a block is sorted by doc id)."""
    idx = _index(spark, sf_dir)
    pl = indexing.posting_lists(idx.postings, idx.vocab, block_size=64)
    pl = pl.select("term", F.size("postings").alias("n"), F.col("postings")[0].alias("first"),
                   F.element_at("postings", -1)["doc_id"].alias("last"),
                   F.aggregate("postings", F.lit(0).cast("bigint"), lambda a, x: a + x["tf"]).alias("cf"))
    return pl.groupBy("term").agg(F.sum("n").alias("df"), F.min("first")["doc_id"].alias("first_doc"),
                                  F.max("last").alias("last_doc"), F.min("first")["tf"].alias("first_tf"),
                                  F.sum("cf").alias("cf"))


@register("a5_merge_partial_postings", f"WITH {IDX} SELECT term, doc_id, tf FROM postings")
def a5_merge_partial_postings(spark, sf_dir):
    """One independent build per language, unioned and summed = the whole-corpus postings."""
    docs = table(spark, sf_dir, "documents")
    langs = ["en", "fr", "de", "es"]
    parts = [indexing.term_frequencies(docs.filter(F.col("lang") == l)).select("term", "doc_id", "tf")
             for l in langs]
    parts.append(indexing.term_frequencies(docs.filter(~F.col("lang").isin(langs) | F.col("lang").isNull()))
                 .select("term", "doc_id", "tf"))
    return indexing.merge_postings(*parts)


@register("a4_posting_lookup",
          f"WITH {IDX},\nasked AS (SELECT term, doc_id FROM postings UNION SELECT term, doc_id + 1 AS doc_id FROM postings) "
          "SELECT a.term, a.doc_id, p.tf FROM asked a LEFT JOIN postings p USING (term, doc_id)")
def a4_posting_lookup(spark, sf_dir):
    """(term, document) pairs looked up by directory and binary search: every posting, and for each the next
    document id, which may hold the term or not."""
    postings = _index(spark, sf_dir).postings
    # postings move by term, so that both ids of a posting are made where equal pairs already meet
    pairs = postings.repartition("term").select("term", F.explode(F.array(F.col("doc_id"), F.col("doc_id") + 1)).alias("doc_id")).distinct()
    return lookup.lookup(lookup.build(postings), pairs).select("term", "doc_id", "tf")


@register("f19_packed_lookup",
          f"WITH {IDX} SELECT term, min(doc_id) AS first_doc, arg_min(tf, doc_id) AS tf_first, "
          "NULL::BIGINT AS tf_absent FROM postings GROUP BY term")
def f19_packed_lookup(spark, sf_dir):
    """look keys up in the packed ``map<doc_id, tf>`` form; an absent key gives NULL."""
    idx = _index(spark, sf_dir)
    pm = indexing.posting_maps(idx.postings, idx.vocab, block_size=64)
    first = F.array_min(F.map_keys("tf_by_doc"))
    pm = pm.select("term", F.struct(first.alias("doc"), F.try_element_at("tf_by_doc", first).alias("tf")).alias("f"),
                   F.try_element_at("tf_by_doc", F.lit(-1).cast("bigint")).alias("absent"))
    return pm.groupBy("term").agg(F.min("f")["doc"].alias("first_doc"), F.min("f")["tf"].alias("tf_first"),
                                  F.max("absent").alias("tf_absent"))


@register("m6_prefix_sweep",
          f"WITH {IDX},\n" + duck.tokens_cte("qkept", "benchmark", "item_id", "text", "query_id") + ",\n"
          "ords AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents),\n"
          "sizes AS (SELECT DISTINCT ceil(n / power(2, i))::BIGINT AS n FROM nd, range(0, 6) t(i)),\n"
          "sp AS (SELECT s.n, p.term, p.doc_id, p.tf FROM postings p JOIN ords o USING (doc_id) JOIN sizes s ON o.ordinal < s.n),\n"
          "sv AS (SELECT n, term, count(*) AS df FROM sp GROUP BY n, term),\n"
          "sw AS (SELECT sp.n, sp.term, sp.doc_id, (1 + log10(sp.tf::DOUBLE)) * log10(sp.n::DOUBLE / sv.df) AS w "
          "FROM sp JOIN sv USING (n, term)),\n"
          "sn AS (SELECT n, doc_id, sqrt(sum(w * w)) AS norm FROM sw GROUP BY n, doc_id),\n"
          "qc AS (SELECT query_id, term, count(*) AS qtf FROM qkept GROUP BY query_id, term),\n"
          "sq AS (SELECT sv.n, qc.query_id, qc.term, (1 + log10(qc.qtf::DOUBLE)) * log10(sv.n::DOUBLE / sv.df) AS qw "
          "FROM qc JOIN sv USING (term)),\n"
          "sqn AS (SELECT n, query_id, sqrt(sum(qw * qw)) AS qnorm FROM sq GROUP BY n, query_id),\n"
          "sd AS (SELECT sq.n, sq.query_id, sw.doc_id, sum(sq.qw * sw.w) AS dot FROM sq JOIN sw USING (n, term) "
          "GROUP BY sq.n, sq.query_id, sw.doc_id),\n"
          "ss AS (SELECT sd.n, sd.query_id, sd.doc_id, sd.dot / nullif(sqn.qnorm * sn.norm, 0) AS score FROM sd "
          "JOIN sqn USING (n, query_id) JOIN sn USING (n, doc_id))\n"
          "SELECT n, query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY n, "
          "query_id ORDER BY round(score, 9) DESC, doc_id)::BIGINT AS rank FROM ss WHERE score IS NOT NULL) WHERE rank <= 5")
def m6_prefix_sweep(spark, sf_dir):
    from ranklight.operators.sweep import prefix_sweep

    out = prefix_sweep(table(spark, sf_dir, "documents"), _queries(spark, sf_dir), k=5, levels=6)
    return out.select("n", "query_id", "rank", "doc_id", r6("score").alias("score"))


USER_TURNS = "(SELECT concat(conv_id, ':', turn) AS item_id, text FROM conversations WHERE role = 'user')"


@register("m4_cosine_user_turns",
          f"WITH {IDX},\n" + duck.query_ctes(USER_TURNS) + f",\n{duck.cosine_ctes()}\n{duck.top_k_sql('scores', K)}")
def m4_cosine_user_turns(spark, sf_dir):
    """M4 with a larger batch: every user turn of ``conversations`` searched against the corpus in one
    plan (query key ``conv_id:turn``)."""
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    q = conv.select(F.concat_ws(":", "conv_id", "turn").alias("query_id"), "text")
    index = _index(spark, sf_dir, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    hits = ranking.cosine_search(index, q, K)
    return hits.select("query_id", "rank", "doc_id", r6("score").alias("score"))
