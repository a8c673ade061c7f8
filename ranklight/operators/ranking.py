"""Ranked text search (M3, M4, M5, M7; J1, J3, A7, A8, W2, T1, P1).

Cosine (the reference's scoring): query weight ``qw = (1 + log10 qtf) · log10(N/df)`` over the query
terms that exist in the vocabulary (unknown terms do not enter the query norm), score
``Σ qw·w / (‖q‖·‖d‖)``.  The index stores ``wn = w/‖d‖`` and the query side is normalised before the
join, so the score is one ``sum(qwn · wn)`` per (query, document) and no norms join is needed.
Undefined scores (a zero norm on either side) are NULL and dropped.

Ties at the cut are broken by ``round(score, 9)`` descending, then the smaller document id.

Top-k per query is ``row_number() <= k`` over ``partition by query_id``: Spark plans a partial
``WindowGroupLimit`` before the shuffle, so at most ``k`` rows per query and map partition cross the
network even when one query matches a third of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ranklight.functions.weighting import bm25_idf, bm25_tf, log_idf, log_tf
from ranklight.operators import scoring
from ranklight.operators.indexing import TextIndex
from ranklight.operators.sizing import MAX_BROADCAST_ROWS, bounded

PUSHED_TERMS = 1000  # query tokens up to which the terms are also a scan filter
MAX_PAIRS = 50_000_000  # (query, document, term) matches up to which they are rows of a join
HIT_COLS = ("query_id", "rank", "doc_id", "score")


def top_k(scores: DataFrame, k: int, key: str = "query_id", score: str = "score", item: str = "doc_id",
          descending: bool = True, rank_col: str = "rank") -> DataFrame:
    """The ``k`` best items per ``key`` with a ``rank`` column (1-based, bigint)."""
    order = F.round(F.col(score), 9)
    order = order.desc() if descending else order.asc()
    w = Window.partitionBy(key).orderBy(order, F.col(item).asc())
    return (scores.withColumn(rank_col, F.row_number().over(w))
                  .filter(F.col(rank_col) <= k)
                  .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def query_terms(index: TextIndex, queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, bool]:
    """``(query_id, term, qtf, df)`` for every query term that exists in the vocabulary.

    Returns the table, the weights to join, and whether it was proven small (then it is broadcast into the joins with the
    vocabulary and the weights, so the index side is never shuffled for a search).  A few short queries (at
    most ``PUSHED_TERMS`` tokens) against a saved index are looked up by :func:`_short_queries`."""
    toks = index.analyze(queries, id_col, text_col, "query_id")
    if index.extra.get("saved") and max_broadcast_rows >= PUSHED_TERMS:
        head = toks.limit(PUSHED_TERMS + 1).collect()
        if len(head) <= PUSHED_TERMS:
            return *_short_queries(index, head, toks.schema["query_id"].dataType), True
    # the raw tokens bound the (query, term) rows from above and need no shuffle to count
    small = bounded(toks, max_broadcast_rows)
    q = toks.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    side = F.broadcast(q) if small else q
    # Q7: inner join on the vocabulary before any norm
    return side.join(index.vocab.select("term", "df"), "term"), index.weights, small


def _short_queries(index: TextIndex, tokens: list, id_type) -> tuple[DataFrame, DataFrame]:
    """Query terms as a local table, and the weights behind a ``term IN (...)`` filter that reaches the
    scan.  ``peers`` has all terms of the row's query, so the query norm needs no shuffle."""
    spark = index.weights.sparkSession
    terms = sorted({r["term"] for r in tokens})
    df = dict(index.vocab.filter(F.col("term").isin(terms)).select("term", "df").collect()) if terms else {}
    count: dict = {}
    for r in tokens:
        if r["term"] in df:
            own = count.setdefault(r["query_id"], {})
            own[r["term"]] = own.get(r["term"], 0) + 1
    schema = StructType([StructField("query_id", id_type), StructField("peers", ArrayType(StructType([
        StructField("term", StringType()), StructField("qtf", LongType()), StructField("df", LongType())])))])
    rows = [(q, [(t, n, df[t]) for t, n in own.items()]) for q, own in count.items()]
    q = spark.createDataFrame(rows, schema).select("query_id", "peers", F.explode("peers").alias("t"))
    return q.select("query_id", "t.*", "peers"), index.weights.filter(F.col("term").isin(terms))


def _cosine_sides(index: TextIndex, queries: DataFrame, id_col: str, text_col: str, max_broadcast_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Query terms ``query_id, term, weight, df``, weights ``term, doc_id, weight``, and whether the terms are few."""
    q, weights, small = query_terms(index, queries, id_col, text_col, max_broadcast_rows)
    def weight(qtf: Column, df: Column) -> Column:
        return log_tf(qtf) * log_idf(index.n_docs, df)

    q = q.withColumn("qw", weight(F.col("qtf"), F.col("df")))
    squares = (F.aggregate("peers", F.lit(0.0), lambda a, t: a + F.pow(weight(t["qtf"], t["df"]), F.lit(2.0)))
               if "peers" in q.columns else F.sum(F.col("qw") * F.col("qw")).over(Window.partitionBy("query_id")))
    q = q.withColumn("qnorm", F.sqrt(squares))
    q = q.select("query_id", "term", F.try_divide(F.col("qw"), F.col("qnorm")).alias("weight"), "df")
    return q, weights.select("term", "doc_id", F.col("wn").alias("weight")), small


def _scores(q: DataFrame, weights: DataFrame, small: bool) -> DataFrame:
    q = q.select("query_id", "term", F.col("weight").alias("value"))
    cand = (F.broadcast(q) if small else q).join(weights, "term")
    s = cand.groupBy("query_id", "doc_id").agg(F.sum(F.col("value") * F.col("weight")).alias("score"))
    return s.filter(F.col("score").isNotNull())


def _hits(index: TextIndex, q: DataFrame, weights: DataFrame, small: bool, k: int, max_pairs: int) -> DataFrame:
    """Top-``k`` hits; the join of query terms and weights is formed only where the document frequencies prove that it has at
    most ``max_pairs`` rows, otherwise ``operators.scoring`` adds the scores up in its tasks."""
    pairs = q.agg(F.coalesce(F.sum(F.col("df").cast("double")), F.lit(0.0))).first()[0]
    if pairs <= max_pairs:
        return top_k(_scores(q, weights, small), k).select(*HIT_COLS)
    n = q.sparkSession.range(1).select(index.n_docs.cast("bigint")).first()[0]
    return top_k(scoring.best(q, weights, n, k), k).select(*HIT_COLS)


def cosine_scores(index: TextIndex, queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A7 + A8 + J1: ``(query_id, doc_id, score)`` for every matched pair, score not NULL."""
    return _scores(*_cosine_sides(index, queries, id_col, text_col, max_broadcast_rows))


def cosine_search(index: TextIndex, queries: DataFrame, k: int = 10, id_col: str = "query_id",
                  text_col: str = "text", max_broadcast_rows: int = MAX_BROADCAST_ROWS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """M3/M4: top-``k`` hits ``(query_id, rank, doc_id, score)`` per query.  Query batches above
    ``max_broadcast_rows`` term rows are joined by shuffle (AQE splits hot terms) instead of broadcast; batches that match more
    than ``max_pairs`` postings are scored part by part."""
    return _hits(index, *_cosine_sides(index, queries, id_col, text_col, max_broadcast_rows), k, max_pairs)


def _bm25_sides(index: TextIndex, queries: DataFrame, id_col: str, text_col: str, k1: float, b: float,
                max_broadcast_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    q, weights, small = query_terms(index, queries, id_col, text_col, max_broadcast_rows)
    q = q.select("query_id", "term", (F.col("qtf").cast("double") * bm25_idf(index.n_docs, F.col("df"))).alias("weight"), "df")
    avg_len = F.try_divide(index.total_len.cast("double"), index.n_docs.cast("double"))
    return q, weights.select("term", "doc_id", bm25_tf(F.col("tf"), F.col("dl"), avg_len, k1, b).alias("weight")), small


def bm25_scores(index: TextIndex, queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                k1: float = 1.2, b: float = 0.75, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """M5 second backend: OR-match of the query terms, BM25 score (Robertson & Zaragoza).
    A query term repeated counts once per occurrence (``qtf`` multiplies its contribution)."""
    return _scores(*_bm25_sides(index, queries, id_col, text_col, k1, b, max_broadcast_rows))


def bm25_search(index: TextIndex, queries: DataFrame, k: int = 10, id_col: str = "query_id",
                text_col: str = "text", k1: float = 1.2, b: float = 0.75,
                max_broadcast_rows: int = MAX_BROADCAST_ROWS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    return _hits(index, *_bm25_sides(index, queries, id_col, text_col, k1, b, max_broadcast_rows), k, max_pairs)


METHODS = {"cosine": cosine_search, "tfidf": cosine_search, "bm25": bm25_search, "fulltext": bm25_search}


def search(index: TextIndex, queries: DataFrame, k: int = 10, method: str = "cosine",
           id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """Dispatch by method name (Q25): unknown names raise ``ValueError``."""
    try:
        fn = METHODS[method]
    except KeyError:
        raise ValueError(f"unknown text search method {method!r}; choose one of {sorted(METHODS)}") from None
    return fn(index, queries, k, id_col, text_col)


def with_documents(hits: DataFrame, docs: DataFrame, columns: dict[str, str] | None = None,
                   id_col: str = "doc_id", max_hits: int | None = None) -> DataFrame:
    """J3 + P1 (M7): attach source columns to the hits in one join instead of one rescan per hit,
    renamed to result headers.  ``columns`` maps source column → header.  No hit → empty result with
    the full schema.  ``max_hits`` is a proven upper bound on the hits (k × number of queries); when it
    is below the broadcast bound the hits are broadcast and the corpus is only scanned, never shuffled.
    Without a bound the join is left to AQE."""
    columns = columns or {"text": "text"}
    src = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c).alias(h) for c, h in columns.items()])
    side = F.broadcast(hits) if max_hits is not None and max_hits <= MAX_BROADCAST_ROWS else hits
    return side.join(src, "doc_id").select("query_id", "rank", "doc_id", *columns.values(), "score")


def search_with_documents(index: TextIndex, queries: DataFrame, docs: DataFrame, k: int = 10,
                          method: str = "cosine", columns: dict[str, str] | None = None,
                          id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """M7: ``search`` then ``with_documents``; the query count (a bounded ``limit`` count) proves the
    hit bound k × |queries| used to broadcast the hits."""
    n_max = MAX_BROADCAST_ROWS // max(1, k)
    n_queries = queries.limit(n_max + 1).count()
    hits = search(index, queries, k, method, id_col, text_col)
    return with_documents(hits, docs, columns, max_hits=k * n_queries if n_queries <= n_max else None)


def single_query(spark, text: str, query_id: int = 0) -> DataFrame:
    """A one-row query table for the single-query API (M3)."""
    return spark.createDataFrame([(query_id, text)], "query_id bigint, text string")
