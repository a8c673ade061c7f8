"""Corpus pipeline: ``documents`` in, encoded training documents out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return the columns of their input, extra columns
unchanged under whatever names.  Null text stays null (language ID rejects it); repeated rows count as documents of their own
until near-dedup, which keeps one.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm import decontaminate, langid, pieces, simhash, substrings
from ranklight.llm.common import table, unused
from ranklight.sources.scratch import materialize

MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9.  A document without a letter, or whose best language has a posterior under one half, goes; so does null
    text, and every document where none has a language to learn from.  Repeated rows stay or go together."""
    model = langid.fit(langid.training_rows(docs))
    pred, score = unused(docs, "lang_pred", "lang_score")
    scored = model.predict(docs, names=(pred, score))
    return scored.filter((F.col(pred) != "und") & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2.  The document with the smallest id of each component stays; of repeated rows one, and a null id comes last.
    Null and empty texts have fingerprint zero and are linked like any other."""
    return simhash.representatives(docs, shingle=3, radius=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3.  Words covered by a 13-word window of an earlier document go; the rest, if any goes, is joined by
    single spaces, and ``n_chars`` follows.  A document that loses all its words stays as an empty text; null stays null."""
    new = unused(docs, *substrings.CUT_COLUMNS)
    cut = substrings.dedup(docs, new=tuple(new))
    changed, kept = F.col(new[1]) > 0, F.col(new[3])
    own = {"text": F.when(changed, kept).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(changed, F.length(kept).cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns(own).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1.  Documents that hold a benchmark item go; null and empty texts hold none.  Repeated rows stay or go
    together, those with null ids too."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7.  Adds ``ids, n_pieces, round_trip``: the ids of the whole text and whether they decode to it (null for null
    text).  They replace columns of their names."""
    return pieces.encode(docs, verify_col="round_trip")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL cannot express the first two stages and the last; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
