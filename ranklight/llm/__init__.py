"""Operators of a training-data pipeline: decontamination, near-duplicate and substring dedup, language
and quality models, n-gram scoring, exact top-k search, tokenisation, conversation repair, whitening and web archives.

Nothing outside this package (besides ``__spark_entry__.py`` and ``corpus_pipeline.py``) imports it.
"""
