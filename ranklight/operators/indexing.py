"""Inverted index build (M1, M2; A1–A6, J7, J8, J9, U1, A5).

Physical shape of :func:`build_index` (no driver round trip; postings and vocabulary are written once
to the checkpoint folder, everything after them is lazy):

* tokens are produced row-locally (``explode`` of the tokenised text), so term frequencies are counted
  by a partial aggregate *before* the first shuffle: one shuffled row per posting, not per token (A1);
* document frequency is a second partial/final aggregate over postings (A2); N is a scalar subquery
  over the corpus (A3), so no cross join is needed to attach it (J7);
* postings ⋈ vocabulary on ``term`` is a plain equi-join: AQE turns it into a broadcast when the
  vocabulary is small at runtime and splits hot-term partitions (skew join) when it is not;
* norms are a partial/final aggregate per document joined back on ``doc_id`` (AQE: broadcast while
  small, skew-split when not); the weights leave that join already divided by their document norm
  (``wn``), so a search needs no norms join at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.text import kept_words, tokens
from ranklight.functions.weighting import log_idf, log_tf
from ranklight.operators.sizing import MAX_BROADCAST_ROWS, bounded, spread
from ranklight.sources.scratch import materialize

HOT_BYTES = 64 << 20  # of texts under one id: more are not analysed by one task
BLOCK_SIZE = 100_000  # postings in one exported row, about
POSTINGS_COLS = ("term", "doc_id", "tf")
WEIGHTS_COLS = ("term", "doc_id", "tf", "df", "w", "wn", "dl")


@dataclass
class TextIndex:
    """A weighted inverted index held as DataFrames.

    ``n_docs`` is a scalar-subquery Column (not a Python int), so everything stays one lazy plan.
    ``stopwords`` is the analysis setting; queries are analysed with the same list.
    """

    postings: DataFrame          # term, doc_id, tf
    vocab: DataFrame             # term, df
    weights: DataFrame           # term, doc_id, tf, df, w, wn, dl
    norms: DataFrame             # doc_id, norm, dl
    n_docs: Column               # scalar: corpus size N (documents without any term included)
    total_len: Column            # scalar: number of kept tokens in the corpus (BM25 average length)
    stopwords: object = None
    extra: dict = field(default_factory=dict)

    def analyze(self, df: DataFrame, id_col: str, text_col: str, out_id: str) -> DataFrame:
        """Rows ``(out_id, term)`` analysed exactly as the corpus was."""
        return tokens(df, id_col, text_col, self.stopwords, out_id=out_id)


def term_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stopwords=None) -> DataFrame:
    """A1: ``(doc_id, term, tf)``, one row per posting."""
    t = tokens(docs, id_col, text_col, stopwords)
    return t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_postings(docs: DataFrame, stopwords: tuple[str, ...], repeated: bool) -> DataFrame:
    """``term, doc_id, tf, dl`` of rows ``doc_id, text`` that lie hashed by ``doc_id``.  A document's words are sorted in its own
    row and counted by runs, so no table of all (document, term) pairs is held; rows of one id are put together first, if
    ``repeated`` says that there are any."""
    words = kept_words(docs, "text", stopwords, "words")
    if repeated:
        words = words.groupBy("doc_id").agg(F.flatten(F.collect_list("words")).alias("words"))
    words = words.select("doc_id", F.size("words").alias("dl"), F.sort_array("words").alias("words"))
    at = F.filter(F.sequence(F.lit(1), F.col("dl")), lambda i: (i == 1) | (F.get("words", i - 1) != F.get("words", i - 2)))
    runs = words.withColumn("at", at)
    ends = F.concat(F.slice("at", F.lit(2), F.size("at")), F.array(F.col("dl") + 1))
    run = F.zip_with("at", ends, lambda a, b: F.struct(F.get("words", a - 1).alias("term"), (b - a).cast("bigint").alias("tf")))
    # outer: an explode, like a filter on the words, would be checked below the exchange too, by analysing each text there as well
    out = runs.select("doc_id", F.col("dl").cast("bigint").alias("dl"), F.explode_outer(run).alias("run"))
    return out.select("run.term", "doc_id", "run.tf", "dl").filter("term IS NOT NULL")


def document_frequencies(postings: DataFrame) -> DataFrame:
    """A2: ``(term, df, cf)``.  ``df`` counts ``tf`` (never NULL, so the same number as ``count(*)``):
    that keeps ``tf`` alive in this branch, the postings subtree stays identical to the one the weights
    read, and Spark reuses its shuffle instead of tokenising the corpus a second time."""
    return postings.groupBy("term").agg(F.count("tf").alias("df"), F.sum("tf").cast("bigint").alias("cf"))


def merge_postings(*parts: DataFrame) -> DataFrame:
    """Union partial posting tables from independent builds and sum their frequencies.
    With disjoint document sets this is exactly the posting table of the combined corpus."""
    u = parts[0].select(*POSTINGS_COLS)
    for p in parts[1:]:
        u = u.unionByName(p.select(*POSTINGS_COLS))
    return u.groupBy("term", "doc_id").agg(F.sum("tf").cast("bigint").alias("tf"))


def weigh(postings: DataFrame, n_docs: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M2: vocabulary, weights (with ``wn = w / ‖d‖`` and document length ``dl``) and norms.

    Norms are a partial/final aggregate per document (one shuffled row per document and map task),
    then joined back on ``doc_id``: AQE broadcasts the norms while they are small and splits a huge
    document's partition (skew join) when they are not."""
    vocab = document_frequencies(postings)
    w = raw_weights(postings, vocab, n_docs)
    norms = doc_norms(w)
    return vocab, normalized_weights(w, norms), norms


def doc_norms(w: DataFrame) -> DataFrame:
    """``doc_id, norm = √Σw², dl = Σtf`` (partial aggregate before the shuffle)."""
    return w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                                   F.sum("tf").cast("bigint").alias("dl"))


def raw_weights(postings: DataFrame, vocab: DataFrame, n_docs: Column) -> DataFrame:
    """J7 + F5·F6: ``term, doc_id, tf, df, w``."""
    return postings.join(vocab.select("term", "df"), "term").withColumn(
        "w", log_tf(F.col("tf")) * log_idf(n_docs, F.col("df")))


def normalized_weights(w: DataFrame, norms: DataFrame) -> DataFrame:
    """``wn = w / ‖d‖`` (NULL for a zero norm) and ``dl`` from the norms table."""
    return w.join(norms, "doc_id").withColumn("wn", F.try_divide(F.col("w"), F.col("norm"))).select(*WEIGHTS_COLS)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stopwords=None,
                materialize_postings: bool = True, buckets: int | None = None) -> TextIndex:
    """M1 + M2.  The corpus is tokenised exactly once: the postings and the vocabulary are written as
    tables in the shared checkpoint folder and weights and norms are lazy plans over them.
    With ``materialize_postings=False`` everything stays one lazy plan (Spark then relies on exchange
    reuse, which column pruning can defeat).

    With ``buckets`` the written postings are bucketed by document, for a saved index or a large batch of queries.  Then the texts travel, which are
    smaller than their postings, and terms are counted where a document's texts lie, unless one id has more than
    ``HOT_BYTES`` of them."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()  # counted on the scan itself (row-group metadata)
    docs = docs.select(id_col, text_col)
    if buckets and heaviest(docs, id_col, text_col) <= HOT_BYTES:
        postings = term_frequencies(docs.repartition(buckets, id_col), id_col, text_col, stopwords).select(*POSTINGS_COLS)
    else:
        postings = term_frequencies(spread(docs), id_col, text_col, stopwords).select(*POSTINGS_COLS)
        postings = postings.repartition(buckets, "doc_id") if buckets else postings
    vocab = document_frequencies(postings)
    if materialize_postings:
        postings = materialize(postings, "postings", bucket_by=(buckets, "doc_id") if buckets else None)
        # the vocabulary is read by the weights, the norms, every query and the token total: write it once
        vocab = materialize(document_frequencies(postings), "vocab")
    # over buckets no posting moves again while the vocabulary is proved small; the norms are the built side: weights are not sorted
    few = buckets and materialize_postings and bounded(vocab.select("term", "df"), MAX_BROADCAST_ROWS)
    w = raw_weights(postings, F.broadcast(vocab) if few else vocab, n_docs)
    norms = doc_norms(w)
    weights = normalized_weights(w, norms.hint("shuffle_hash") if few else norms)
    total_len = vocab.select(F.coalesce(F.sum("cf"), F.lit(0)).cast("bigint")).scalar()
    index = TextIndex(postings, vocab, weights, norms, n_docs, total_len, stopwords)
    index.extra.update(buckets=buckets if materialize_postings else None)
    return index


def heaviest(docs: DataFrame, id_col: str, text_col: str) -> int:
    """The bytes of the texts under the id that has most."""
    own = docs.groupBy(id_col).agg(F.sum(F.octet_length(F.col(text_col))).alias("size"))
    return own.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]


def in_blocks(postings: DataFrame, vocab: DataFrame, block_size: int) -> DataFrame:
    """Postings with a ``block`` number: a term's documents are dealt by hash into as many blocks as hold
    about ``block_size`` of them, so no block grows with the term's document frequency."""
    blocks = F.ceil(F.col("df") / F.lit(float(block_size)))
    return postings.join(vocab.select("term", "df"), "term").withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), blocks).cast("long"))


def posting_lists(postings: DataFrame, vocab: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """A4/T4 export form: ``term, block, df, postings array<struct<doc_id, tf>>``, each block sorted by doc id."""
    return in_blocks(postings, vocab, block_size).groupBy("term", "block").agg(
        F.first("df").alias("df"), F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))


def posting_maps(postings: DataFrame, vocab: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Packed ``term, block, map<doc_id, tf>`` form for F19 lookups (``try_element_at``)."""
    return in_blocks(postings, vocab, block_size).groupBy("term", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("doc_id", "tf"))).alias("tf_by_doc"))
