"""M6 + S10: search quality/latency sweep over growing corpus prefixes, in one job.

The reference rebuilds its index once per prefix size (sizes double up to the full corpus).  Here every posting is
counted once, whatever the number of sizes: a term's document frequencies in all prefixes are sums over its postings, taken side
by side in one aggregate; so are a document's norms and the products of a query and a document.  Only the
finished scores of a (query, document) are spread over the sizes, and the k best of each pass on.

Postings lie by document, where their texts moved to: while vocabulary and query terms are proved small and broadcast, neither
weights nor norms nor products move again.

Sizes follow the reference's rule (each size doubles the previous one, the last is the whole corpus):
``ceil(N / 2^i)`` for ``i < levels``, computed from the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.text import tokens
from ranklight.functions.weighting import log_idf, log_tf
from ranklight.operators.indexing import HOT_BYTES, heaviest, term_frequencies
from ranklight.operators.ranking import top_k
from ranklight.operators.sizing import MAX_BROADCAST_ROWS, bounded, spread
from ranklight.operators.tables import with_ordinal
from ranklight.sources.scratch import materialize


def prefix_sizes(n_docs, levels: int = 6):
    """``array<bigint>`` of distinct prefix sizes, largest first."""
    return F.array_distinct(F.array(*[F.ceil(n_docs / F.lit(2.0 ** i)).cast("bigint") for i in range(levels)]))


def prefix_sweep(docs: DataFrame, queries: DataFrame, k: int = 5, levels: int = 6, id_col: str = "doc_id",
                 text_col: str = "text", query_id_col: str = "query_id", query_text_col: str = "text",
                 stopwords=None) -> DataFrame:
    """``(n, query_id, rank, doc_id, score)``: cosine top-k per query for every prefix size ``n``."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    sizes = [F.ceil(n_docs / F.lit(2.0 ** i)).cast("bigint") for i in range(levels)]
    steps = range(levels)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ords = with_ordinal(spread(docs.select("doc_id")), ["doc_id"])
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if heaviest(docs, "doc_id", "text") <= HOT_BYTES:  # texts move by document, and what is counted from them stays there
        postings = term_frequencies(docs.repartition(buckets, "doc_id"), stopwords=stopwords)
    else:
        postings = term_frequencies(spread(docs), stopwords=stopwords).repartition(buckets, "doc_id")
    postings = materialize(postings.join(ords.hint("shuffle_hash"), "doc_id"), "sweep-postings", bucket_by=(buckets, "doc_id"))

    def inside(i: int, value) -> Column:
        """The value for documents of the i-th prefix, else NULL (which sums leave out)."""
        return F.when(F.col("ordinal") < sizes[i], value)

    vocab = postings.groupBy("term").agg(*[F.count(inside(i, F.lit(1))).alias(f"df{i}") for i in steps])
    vocab = materialize(vocab, "sweep-vocab")
    weighted = postings.join(F.broadcast(vocab) if bounded(vocab, MAX_BROADCAST_ROWS) else vocab, "term").select("term", "doc_id", *[
        inside(i, log_tf("tf") * log_idf(sizes[i], F.col(f"df{i}"))).alias(f"w{i}") for i in steps])
    norms = weighted.groupBy("doc_id").agg(*[F.sqrt(F.sum(F.col(f"w{i}") * F.col(f"w{i}"))).alias(f"norm{i}") for i in steps])

    q = tokens(queries, query_id_col, query_text_col, stopwords, out_id="query_id")
    small = bounded(q, MAX_BROADCAST_ROWS)
    q = q.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    q = (F.broadcast(q) if small else q).join(vocab, "term")
    q = q.select("query_id", "term", *[(log_tf("qtf") * log_idf(sizes[i], F.col(f"df{i}"))).alias(f"qw{i}") for i in steps])
    qnorms = q.groupBy("query_id").agg(*[F.sqrt(F.sum(F.col(f"qw{i}") * F.col(f"qw{i}"))).alias(f"qnorm{i}") for i in steps])
    dots = weighted.join(F.broadcast(q) if small else q, "term").groupBy("query_id", "doc_id").agg(
        *[F.sum(F.col(f"qw{i}") * F.col(f"w{i}")).alias(f"dot{i}") for i in steps])
    found = dots.join(norms.hint("shuffle_hash"), "doc_id").join(F.broadcast(qnorms) if small else qnorms, "query_id")
    scores = [F.struct(sizes[i].alias("n"), F.try_divide(F.col(f"dot{i}"), F.col(f"qnorm{i}") * F.col(f"norm{i}")).alias("score")) for i in steps]
    # sizes of a small corpus may coincide: equal ones have equal scores and count once
    s = found.select("query_id", "doc_id", F.explode(F.array_distinct(F.array(*scores))).alias("s"))
    s = s.select("query_id", "doc_id", "s.n", "s.score").filter(F.col("score").isNotNull())
    s = s.withColumn("key", F.struct("n", "query_id"))
    return top_k(s, k, key="key").select("n", "query_id", "rank", "doc_id", "score")


def write_prefixes(df: DataFrame, order_by: list[str], path: str, levels: int = 6) -> None:
    """Write the first n rows for every prefix size n in one pass, partitioned by ``n``."""
    n_rows = df.select(F.count(F.lit(1))).scalar()
    o = with_ordinal(df, order_by)
    o = o.withColumn("_sizes", prefix_sizes(n_rows, levels))
    o = o.withColumn("n", F.explode(F.filter("_sizes", lambda s: s > F.col("ordinal")))).drop("_sizes")
    o.drop("ordinal").write.mode("overwrite").partitionBy("n").parquet(path)
