"""Table utilities.

Row ordinals (P4) are assigned without a single-partition window: the table is range-partitioned on
its ordering key (hot key ranges are split by the sampler), each row gets its position inside its
partition, and per-partition counts — one small row per partition and group — give the offsets.
The positioned table is written once to the checkpoint folder so both consumers see the same split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklight.sources.scratch import materialize

_LOW33 = (1 << 33) - 1


def with_ordinal(df: DataFrame, order_by: list[str], group_by: list[str] | None = None, name: str = "ordinal",
                 partitions: int | None = None) -> DataFrame:
    """Consecutive 0-based ordinals in ``order_by`` order (within each ``group_by`` group).

    ``order_by`` (+ ``group_by``) must be unique for the result to be deterministic."""
    group_by = group_by or []
    spark = df.sparkSession
    n = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*group_by, *order_by]
    r = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("_mid", F.monotonically_increasing_id()))
    r = r.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    # The range bounds are sampled per exchange (seeded by RDD id), so two evaluations of ``r`` could
    # split rows differently.  Writing ``r`` once fixes the positions for both consumers below and for
    # any task recomputed after an executor loss.
    r = materialize(r, "ordinals")
    stats = r.groupBy("_pid", *group_by).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    out = r.join(stats.select("_pid", *group_by, "_first", "_off"), ["_pid", *group_by])
    out = out.withColumn(name, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint"))
    return out.drop("_mid", "_pid", "_loc", "_first", "_off")


def leading_columns(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` columns."""
    return df.select(*df.columns[:n])


def length_filter(df: DataFrame, seconds_col: str, max_minutes: float) -> tuple[DataFrame, DataFrame]:
    """P7 + F15: keep items of at most ``max_minutes`` (seconds / 60), and the table of the others."""
    minutes = F.col(seconds_col) / F.lit(60.0)
    return df.filter(minutes <= max_minutes), df.filter(minutes > max_minutes)


def shape(df: DataFrame) -> DataFrame:
    """A10: ``rows`` and ``cells`` (rows × columns) in one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) * F.lit(len(df.columns))).alias("cells"))


def label(*cols, sep: str = " - ") -> Column:
    """``a - b - c`` labels."""
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols])


def fixed4(c) -> Column:
    """F16: score with four decimals as text."""
    return F.format_string("%.4f", c if isinstance(c, Column) else F.col(c))


def to_long(c) -> Column:
    """string ids to integers (numeric order)."""
    return (c if isinstance(c, Column) else F.col(c)).cast("bigint")
