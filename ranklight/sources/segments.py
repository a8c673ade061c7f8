"""A text index that grows: immutable segments, tombstones, mergeable norm statistics.

A store is a manifest (``sources.manifest``) over immutable folders::

    seg-*/postings  term, doc_id, tf, dl      hashed by document, sorted by term
    seg-*/vocab     term, df, cf              the segment's own counts
    seg-*/docs      doc_id, copies, dl        every row of the segment, documents without a term included
    gone-*/docs     seg, doc_id, copies       documents of older segments that a later one replaces
    gone-*/vocab    term, df, cf              what they had counted
    stats-*         seg, doc_id, a, b, c      additive norm statistics
    exact-*         seg, doc_id, squares      norms that the statistics cannot tell from zero

The counts of a version are sums: df and cf over segments less those of the replaced documents, N and the token total over the
state's numbers.  A norm is ``sum tfw^2 (L - l)^2`` with ``L = log10 N`` and ``l = log10 df``, so three sums for each document
give it for any N::

    a = sum tfw^2    b = sum tfw^2 l    c = sum tfw^2 l^2    norm^2 = L^2 a - 2 L b + c

An append adds the statistics of its own documents and, for older ones, the change that a changed df makes: only postings of
terms that the new segment (or a replaced document) has are read.  Where the three terms cancel almost wholly, rounding
would stand for the norm; such documents' norms are summed from their postings when the version is made.

A version is committed by one row that is written last: a failed write leaves the store as it was, and a :class:`Snapshot`
goes on reading the folders of its version.  :func:`merge` rewrites small segments and those with replaced documents as one,
by union and sums, and leaves the others as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ranklight.functions.text import ANALYSIS, resolve_stopwords, tokens
from ranklight.functions.weighting import bm25_idf, bm25_tf, log_idf, log_tf
from ranklight.operators import indexing
from ranklight.operators.ranking import HIT_COLS, top_k
from ranklight.operators.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, bounded
from ranklight.sources import manifest
from ranklight.sources.index_store import SORTED
from ranklight.sources.scratch import materialize

STATE = ("array<struct<seg: bigint, folder: string, docs: bigint>>")
CANCELLED = 1e-7  # of L^2 a: below this the statistics leave too few digits


@dataclass
class Snapshot:
    """One version of a store, read lazily.  Its folders do not change."""

    spark: SparkSession
    path: str
    state: Row

    def _folders(self, of: str) -> list[str]:
        return [f"{s.folder}/{of}" for s in self.state.segments]

    def _of_segments(self, table: str, schema: str) -> DataFrame:
        parts = [self.spark.read.schema(schema).parquet(f"{s.folder}/{table}").withColumn("seg", F.lit(s.seg).cast("bigint"))
                 for s in self.state.segments]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], f"{schema}, seg bigint")

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    @property
    def gone(self) -> DataFrame:
        return self._read([f"{f}/docs" for f in self.state.gone], "seg bigint, doc_id bigint, copies bigint")

    def _live(self, df: DataFrame) -> DataFrame:
        """Without the rows of replaced documents."""
        return df.join(self.gone.select("seg", "doc_id"), ["seg", "doc_id"], "left_anti") if self.state.gone else df

    @property
    def postings(self) -> DataFrame:
        """``term, doc_id, tf, dl, seg`` of all live documents."""
        return self._live(self._of_segments("postings", "term string, doc_id bigint, tf bigint, dl bigint"))

    @property
    def documents(self) -> DataFrame:
        """``doc_id, copies, dl, seg`` of all live documents."""
        return self._live(self._of_segments("docs", "doc_id bigint, copies bigint, dl bigint"))

    @property
    def signed_counts(self) -> DataFrame:
        """``term, df, cf`` of the segments, and negative of the replaced documents."""
        schema = "term string, df bigint, cf bigint"
        own = self._of_segments("vocab", schema).drop("seg")
        less = self._read([f"{f}/vocab" for f in self.state.gone], schema).select("term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))
        return own.unionAll(less)

    @property
    def vocab(self) -> DataFrame:
        """``term, df, cf``: sums over the segments less the replaced documents."""
        return self.signed_counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")

    @property
    def statistics(self) -> DataFrame:
        """``seg, doc_id, a, b, c`` of all live documents with a term."""
        live = [s.seg for s in self.state.segments]
        rows = self._read(list(self.state.stats), "seg bigint, doc_id bigint, a double, b double, c double").filter(F.col("seg").isin(live))
        return self._live(rows.groupBy("seg", "doc_id").agg(*[F.sum(x).alias(x) for x in "abc"]))

    @property
    def norms(self) -> DataFrame:
        """``seg, doc_id, norm``."""
        exact = self._read(list(self.state.exact), "seg bigint, doc_id bigint, squares double")
        squares = F.coalesce("squares", _squares(self.state.n_docs))
        return self.statistics.join(exact, ["seg", "doc_id"], "left").select("seg", "doc_id", F.sqrt(F.greatest(squares, F.lit(0.0))).alias("norm"))

    @property
    def stopwords(self):
        return tuple(self.state.stopwords)

    def folders(self) -> set[str]:
        return {s.folder for s in self.state.segments} | set(self.state.gone) | set(self.state.stats) | set(self.state.exact)


def _squares(n_docs: int) -> Column:
    big = F.log10(F.lit(float(max(1, n_docs))))
    return big * big * F.col("a") - 2 * big * F.col("b") + F.col("c")


def open_store(spark: SparkSession, path: str) -> Snapshot:
    state = manifest.latest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no store at {path}")
    if state["analysis"] != ANALYSIS:
        raise ValueError(f"store was analysed with {state['analysis']!r}, this library uses {ANALYSIS!r}")
    return Snapshot(spark, path, state)


def _commit(spark: SparkSession, path: str, base: int, **state) -> Snapshot:
    schema = (f"segments {STATE}, gone array<string>, stats array<string>, exact array<string>, next_seg bigint, n_docs bigint, "
              "total_len bigint, analysis string, stopwords array<string>, buckets int")
    names = [f.split()[0] for f in ("segments", "gone", "stats", "exact", "next_seg", "n_docs", "total_len", "analysis", "stopwords", "buckets")]
    row = spark.createDataFrame([tuple(state[n] for n in names)], schema)
    return Snapshot(spark, path, manifest.commit(spark, path, row, base))


def create(spark: SparkSession, path: str, stopwords=None, buckets: int | None = None) -> Snapshot:
    """An empty store.  The stop list is fixed with it."""
    words = resolve_stopwords(stopwords)
    if isinstance(words, DataFrame):
        raise ValueError("a growing store keeps its stop list in the manifest: pass the words")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _commit(spark, path, 0, segments=[], gone=[], stats=[], exact=[], next_seg=0, n_docs=0, total_len=0, analysis=ANALYSIS,
                   stopwords=list(words), buckets=buckets)


def _write_postings(postings: DataFrame, folder: str) -> None:
    postings.select("term", "doc_id", "tf", "dl").sortWithinPartitions("term", "doc_id").write.options(**SORTED).parquet(f"{folder}/postings")


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))


def _postings(own: DataFrame, rows: DataFrame, buckets: int, stopwords: tuple[str, ...]) -> DataFrame:
    """``term, doc_id, tf, dl`` hashed by document.  Texts travel, which are smaller than their postings, and are counted where they
    lie, unless one id has more than ``indexing.HOT_BYTES`` of them."""
    own = own.filter("doc_id IS NOT NULL")
    copies, size = rows.filter("doc_id IS NOT NULL").agg(F.coalesce(F.max("copies"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    if size <= indexing.HOT_BYTES:
        return indexing.document_postings(own.repartition(buckets, "doc_id"), stopwords, copies > 1)
    tf = materialize(indexing.term_frequencies(own, stopwords=stopwords), "segment-counts")
    return tf.join(tf.groupBy("doc_id").agg(F.sum("tf").cast("bigint").alias("dl")), "doc_id").repartition(buckets, "doc_id")


def _with_counts(postings: DataFrame, counts: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """Postings with the columns of ``counts`` (``term, top, ...``), null where it lacks the term.

    The counts are broadcast.  Where they are too many, those of the frequent terms are (by powers of two of ``top``, as many as the
    bounds allow), and only the few postings of rarer terms are shuffled."""
    power = F.floor(F.log2("top"))
    held, rows, size = None, 0, 0
    for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("size")).orderBy(F.desc("power")).collect():
        rows, size = rows + r.n, size + r.size
        if rows > max_rows or size > max_bytes:
            break
        held = r.power  # one row for each power of two
    else:
        return postings.join(F.broadcast(counts), "term", "left")
    often = F.lit(False) if held is None else power >= held
    rest = postings.join(F.broadcast(counts.filter(often).select("term")), "term", "left_anti").join(counts.filter(~often), "term", "left")
    return postings.join(F.broadcast(counts.filter(often)), "term").unionByName(rest)


def _statistics(postings: DataFrame, counts: DataFrame, new: int, max_rows: int, max_bytes: int) -> DataFrame:
    """``seg, doc_id, a, b, c``: the statistics of the documents of segment ``new``, and the changes to those of older ones, from
    ``term, df, was, own``: the counts of this version, of the one before and of the new segment."""
    fresh = F.col("seg") == new
    log = lambda n: F.when(F.col(n) > 0, F.log10(F.col(n).cast("double"))).otherwise(0.0)
    # a new term of one document has l = 0: it needs no row
    used = counts.filter("df > 0 AND (own > 0 AND df > 1 OR was > 0 AND df <> was)").select(
        "term", F.greatest("df", "was").alias("top"), log("df").alias("l"), log("was").alias("k"))
    l, k = F.coalesce("l", F.lit(0.0)), F.when(fresh, 0.0).otherwise(F.coalesce("k", F.lit(0.0)))
    w2 = F.pow(log_tf(F.col("tf")), F.lit(2.0))
    return _with_counts(postings, used, max_rows, max_bytes).filter(fresh | F.col("top").isNotNull()).groupBy("seg", "doc_id").agg(
        F.sum(F.when(fresh, w2).otherwise(0.0)).alias("a"), F.sum(w2 * (l - k)).alias("b"), F.sum(w2 * (l * l - k * k)).alias("c"))


def append(base: Snapshot, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Snapshot:
    """A new version with the rows of ``docs``.  A document whose id the store has is replaced.

    Raises ``manifest.Conflict`` if another writer has committed since ``base``; nothing is visible then."""
    spark, path, old = base.spark, base.path, base.state
    seg, folder = old.next_seg, manifest.new_folder(path, "seg")
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.sum(F.octet_length("text")).alias("size"))
    rows = materialize(rows, "segment-rows")
    _write_postings(_postings(own, rows, old.buckets, tuple(old.stopwords)), folder)
    postings = spark.read.parquet(f"{folder}/postings")
    dl = postings.groupBy("doc_id").agg(F.max("dl").alias("dl"))
    rows.join(dl, "doc_id", "left").select("doc_id", "copies", F.coalesce("dl", F.lit(0)).cast("bigint").alias("dl")).write.parquet(f"{folder}/docs")
    _counts(postings).repartition(old.buckets, "term").sortWithinPartitions("term").write.options(**SORTED).parquet(f"{folder}/vocab")
    new_docs = spark.read.parquet(f"{folder}/docs")
    added, length = new_docs.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum("dl"), F.lit(0))).first()
    segments = [*old.segments, Row(seg=seg, folder=folder, docs=added)]

    gone, less, less_len = list(old.gone), 0, 0
    if old.segments:
        replaced = base.documents.join(new_docs.select("doc_id"), "doc_id", "left_semi")
        gone_folder = manifest.new_folder(path, "gone")
        replaced.select("seg", "doc_id", "copies", "dl").write.parquet(f"{gone_folder}/docs")
        replaced = spark.read.parquet(f"{gone_folder}/docs")
        less, less_len = replaced.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum("dl"), F.lit(0))).first()
        if less:
            lost = base.postings.join(replaced.select("seg", "doc_id"), ["seg", "doc_id"], "left_semi")
            _counts(lost).write.parquet(f"{gone_folder}/vocab")
            gone.append(gone_folder)
    state = dict(segments=segments, gone=gone, next_seg=seg + 1, n_docs=old.n_docs + added - less, total_len=old.total_len + length - less_len,
                 analysis=old.analysis, stopwords=list(old.stopwords), buckets=old.buckets)
    next_ = Snapshot(spark, path, Row(**state, stats=list(old.stats), exact=[]))

    stats = manifest.new_folder(path, "stats")
    own_counts = spark.read.parquet(f"{folder}/vocab").select("term", "df", F.lit(0).alias("was"), F.col("df").alias("own"))
    counts = base.signed_counts.select("term", "df", F.col("df").alias("was"), F.lit(0).alias("own")).unionByName(own_counts)
    if less:
        counts = counts.unionByName(spark.read.parquet(f"{gone[-1]}/vocab").select("term", (-F.col("df")).alias("df"), F.lit(0).alias("was"), F.lit(0).alias("own")))
    counts = materialize(counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "was", "own")]), "segment-vocab")
    _statistics(next_.postings, counts, seg, MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES).write.parquet(stats)
    state |= {"stats": [*old.stats, stats]}
    return _commit(spark, path, old.version, **state, exact=_exact(Snapshot(spark, path, Row(**state, exact=[])), counts.filter("df > 0")))


def _exact(now: Snapshot, vocab: DataFrame) -> list[str]:
    """A folder with the squared norms of documents whose statistics cancel, summed from their postings."""
    folder = manifest.new_folder(now.path, "exact")
    big = F.log10(F.lit(float(max(1, now.state.n_docs))))
    close = now.statistics.filter(_squares(now.state.n_docs) <= CANCELLED * big * big * F.col("a")).select("seg", "doc_id")
    w = log_tf(F.col("tf")) * log_idf(F.lit(now.state.n_docs), F.col("df"))
    own = now.postings.join(close, ["seg", "doc_id"], "left_semi").join(vocab.select("term", "df"), "term")
    own.groupBy("seg", "doc_id").agg(F.sum(w * w).alias("squares")).write.parquet(folder)
    return [folder]


def merge(base: Snapshot, max_docs: int) -> Snapshot:
    """A new version in which the segments of at most ``max_docs`` documents, and those with replaced documents, are one.

    The others stay as they are.  Counts are sums; no text is read."""
    spark, path, old = base.spark, base.path, base.state
    hit = {r.seg for r in base.gone.select("seg").distinct().collect()}  # segment numbers
    small = [s for s in old.segments if s.docs <= max_docs or s.seg in hit]
    if not small or len(small) == 1 and not hit:
        return base
    seg, folder, stats = old.next_seg, manifest.new_folder(path, "seg"), manifest.new_folder(path, "stats")
    numbers = [s.seg for s in small]

    def own(df: DataFrame) -> DataFrame:
        return df.filter(F.col("seg").isin(numbers)).drop("seg")

    _write_postings(own(base.postings).repartition(old.buckets, "doc_id"), folder)
    own(base.documents).select("doc_id", "copies", "dl").write.parquet(f"{folder}/docs")
    _counts(spark.read.parquet(f"{folder}/postings")).repartition(old.buckets, "term").sortWithinPartitions("term").write.options(
        **SORTED).parquet(f"{folder}/vocab")
    base.statistics.withColumn("seg", F.when(F.col("seg").isin(numbers), F.lit(seg)).otherwise(F.col("seg")).cast("bigint")).write.parquet(stats)
    docs = spark.read.parquet(f"{folder}/docs").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    state = dict(segments=[s for s in old.segments if s.seg not in numbers] + [Row(seg=seg, folder=folder, docs=docs)], gone=[], stats=[stats],
                 next_seg=seg + 1, n_docs=old.n_docs, total_len=old.total_len, analysis=old.analysis, stopwords=list(old.stopwords),
                 buckets=old.buckets)
    now = Snapshot(spark, path, Row(**state, exact=[]))
    return _commit(spark, path, old.version, **state, exact=_exact(now, now.vocab))


def drop_unused(now: Snapshot) -> list[str]:
    """Removes the folders that ``now`` does not name (for when no older snapshot is in use)."""
    return manifest.vacuum(now.spark, now.path, now.folders())


def search(now: Snapshot, queries: DataFrame, k: int = 10, method: str = "cosine", id_col: str = "query_id", text_col: str = "text",
           k1: float = 1.2, b: float = 0.75, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Top-``k`` hits ``query_id, rank, doc_id, score`` over a snapshot; the same as a search on an index built at once.

    Query terms are broadcast when a count has proved them few; otherwise the join shuffles."""
    if method not in ("cosine", "tfidf", "bm25", "fulltext"):
        raise ValueError(f"unknown text search method {method!r}")
    words = tokens(queries, id_col, text_col, now.stopwords, out_id="query_id")
    small = bounded(words, max_broadcast_rows)
    side = F.broadcast if small else (lambda df: df)
    q = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    q = side(q).join(now.vocab.select("term", "df"), "term")
    n = F.lit(now.state.n_docs)
    if method in ("bm25", "fulltext"):
        avg = F.lit(now.state.total_len / now.state.n_docs if now.state.n_docs else None).cast("double")
        cand = side(q).join(now.postings, "term")
        part = F.col("qtf").cast("double") * bm25_idf(n, F.col("df")) * bm25_tf(F.col("tf"), F.col("dl"), avg, k1, b)
        scores = cand.groupBy("query_id", "seg", "doc_id").agg(F.sum(part).alias("score"))
    else:
        q = q.withColumn("idf", log_idf(n, F.col("df"))).withColumn("qw", log_tf(F.col("qtf")) * F.col("idf"))
        norm = q.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
        cand = side(q.select("query_id", "term", "idf", "qw")).join(now.postings, "term")
        dots = cand.groupBy("query_id", "seg", "doc_id").agg(F.sum(F.col("qw") * F.col("idf") * log_tf(F.col("tf"))).alias("dot"))
        scores = dots.join(now.norms, ["seg", "doc_id"]).join(norm, "query_id").withColumn(
            "score", F.try_divide(F.col("dot"), F.col("qnorm") * F.col("norm")))
    return top_k(scores.filter(F.col("score").isNotNull()), k).select(*HIT_COLS)
