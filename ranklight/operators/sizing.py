"""Size checks in front of every explicit broadcast.

A side is broadcast only after its rows, and the bytes of its strings, are proven below a bound; beyond the bound the caller
takes its shuffle-based path instead.  The check runs over ``limit(n + 1)`` rows, so it stops reading as soon as the bound is
exceeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bounds for broadcast query batches: term rows of all queries together, and the bytes of their strings.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 << 20


def bounded(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    size = F.lit(0) if not text else sum(text[1:], text[0])
    rows, held = df.limit(max_rows + 1).select(size.cast("long").alias("size")).agg(F.count("size"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster only when its scan yields fewer partitions than there are
    cores (one big row group reads as one task).  Inputs that are already split — the normal case for
    large tables — pass through untouched, so no shuffle is added at scale."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    return df.repartition(want) if have < want else df
