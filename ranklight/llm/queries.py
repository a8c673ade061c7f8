"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ranklight.llm import (conversations, decontaminate, katz, langid, pieces, quality, simhash, substrings, suffixes, token_counts,
                           topk, warc, whitening)
from ranklight.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_benchmark_decontamination", decontaminate.ORACLE)
def op1_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_simhash_dedup")
def op2_simhash_dedup(spark, sf_dir):
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return near.select("doc_id", "fingerprint", "component_id")


@register("op4_katz_scores")
def op4_katz_scores(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"))


@register("op5_exact_topk", topk.ORACLE)
def op5_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


@register("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    return suffixes.dedup(table(spark, sf_dir, "documents"), length=200, with_text=False)


@register("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), verify_col="round_trip").drop("text")


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@register("op9_language_id")
def op9_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup(docs, window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir):
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


@register("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=32)


@register("op13_warc_archive", warc.ORACLE)
def op13_warc_archive(spark, sf_dir):
    return warc.archive_and_read(table(spark, sf_dir, "pages")).drop("url")
