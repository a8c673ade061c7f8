"""Registered whole-table queries: name → (spark, sf_dir) → DataFrame, each with a DuckDB twin.

Every query reads the driver tables in full (no id subsets, prefixes or row caps); limits appear only
where they are the feature (top-k).  Floating outputs are rounded to 6 places on both sides, and ties
at a cut are broken by ``round(x, 9)`` then id, so both engines choose the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.plans import duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

K = 10


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c) -> F.Column:
    return F.round(c if isinstance(c, F.Column) else F.col(c), 6)


# Import the query modules so that their @register decorators run.
from ranklight.plans import text_queries, vector_queries, feature_queries, table_queries  # noqa: E402,F401
