"""Materialisation in the cluster's shared checkpoint folder.

Lineage is cut by writing a Parquet table under ``spark.checkpoint.dir`` (read from the session; a
private temp folder only when it is unset, as in local tests) and reading it back.  A written table
survives executor loss, unlike ``localCheckpoint``, and is read with normal scan pruning.

Results are lazy, so their scratch tables must outlive the call that made them.  :func:`run` says how long: every table
written inside the ``with`` block lies in a folder of its own, which is removed when the block ends.  Outside of a run, tables
stay until :func:`purge` removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ranklight.session import checkpoint_dir


_RUN: ContextVar[str] = ContextVar("ranklight_run", default="ranklight")


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """``with run(spark):`` — scratch tables written inside are removed at its end; read or write the results before that."""
    name = f"ranklight-run-{uuid.uuid4().hex}"
    token = _RUN.set(name)
    try:
        yield name
    finally:
        _RUN.reset(token)
        purge(spark, name)


def purge(spark: SparkSession, name: str = "ranklight") -> bool:
    """Removes the scratch tables of a run (by default those written outside of one); whether there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """``df`` written and read back; with ``bucket_by`` as a catalogue table whose buckets are known to the planner."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{_RUN.get()}/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    if bucket_by:
        declared = "ranklight_" + path.rsplit("/", 1)[-1].replace("-", "_")
        w.format("parquet").option("compression", "zstd").bucketBy(*bucket_by).option("path", path).saveAsTable(declared)
        return spark.table(declared)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
