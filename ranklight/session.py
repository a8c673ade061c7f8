"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets.  AQE re-plans joins at runtime (broadcast when a shuffled side turns
# out small, split skewed partitions otherwise) and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ranklight", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one with the defaults above.

    On a cluster the session normally already exists (spark-submit); it is returned as it is.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RANKLIGHT_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage (``spark.checkpoint.dir``).

    The cluster's own setting always wins (or a checkpoint folder already set on the context).  Only a
    ``local[...]`` session without one (tests, single-machine runs) gets a private temp folder; on a
    cluster an unset ``spark.checkpoint.dir`` is an error, because a driver-local folder is invisible
    to the executors."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # one process; local-cluster[...] is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="ranklight-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
