"""Term weighting (F5, F6) and the BM25 pieces, as Column expressions.

Every ratio goes through ``try_divide`` (Spark 4 runs in ANSI mode, where ``x / 0`` raises); a NULL
result means "undefined" and such rows are dropped by the callers, never turned into 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    """Columns pass through, strings name columns, numbers become literals."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def log_tf(tf) -> Column:
    """``1 + log10(tf)`` for ``tf > 0``, else 0."""
    tf = _c(tf)
    return F.when(tf > 0, F.lit(1.0) + F.log10(tf.cast("double"))).otherwise(F.lit(0.0))


def log_idf(n_docs, df) -> Column:
    """``log10(N / df)`` for ``df > 0``, else 0.  Unsmoothed: a term in every document weighs 0.
    (Not ``pyspark.ml.feature.IDF``, which is a smoothed natural log.)"""
    n_docs, df = _c(n_docs), _c(df)
    return F.when(df > 0, F.log10(F.try_divide(n_docs.cast("double"), df.cast("double")))).otherwise(F.lit(0.0))


def bm25_idf(n_docs, df) -> Column:
    """Robertson–Spärck Jones idf with the +1 inside the log, so it is never negative."""
    n_docs, df = _c(n_docs).cast("double"), _c(df).cast("double")
    return F.log(F.lit(1.0) + F.try_divide(n_docs - df + F.lit(0.5), df + F.lit(0.5)))


def bm25_tf(tf, doc_len, avg_len, k1: float = 1.2, b: float = 0.75) -> Column:
    """Saturated, length-normalised term frequency of BM25."""
    tf, doc_len, avg_len = _c(tf).cast("double"), _c(doc_len).cast("double"), _c(avg_len).cast("double")
    denom = tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.try_divide(doc_len, avg_len))
    return F.try_divide(tf * F.lit(k1 + 1.0), denom)
