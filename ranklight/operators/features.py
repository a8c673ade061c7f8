"""Feature work around the vector search.

Signals are long-form rows ``(key, order…, value)``.  Windowing, per-window padding, pooling and the
final pad/cut are positional arithmetic on an ordinal, so one long signal (a key holding a third of all
rows) is spread over many tasks: ordinals come from the range-partitioned ``with_ordinal`` and the mean
over windows is a partial/final aggregate on ``(key, position)``.  Arrays appear only at the end, per
key, with a fixed bounded length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklight.operators.tables import with_ordinal


def signal_features(signals: DataFrame, key: str, order_by: list[str], value: str, window: int,
                    window_len: int | None = None, out_len: int | None = None) -> DataFrame:
    """M17 in long form: ``(key, pos, value)`` for ``pos < out_len``.

    Full windows of ``window`` samples (a partial last window is dropped, Q19); each window padded or
    cut to ``window_len`` (F9); element-wise mean over the windows (A9); padded or cut to ``out_len``.
    Keys shorter than one window have no features and are absent (P6)."""
    window_len = window_len or window
    out_len = out_len or window_len
    keep = min(window, window_len, out_len)
    o = with_ordinal(signals.select(key, *order_by, value), order_by, [key])
    counts = signals.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))  # from the input: no ordinal needed
    full = counts.filter(F.col("_n") >= window).select(key, (F.floor(F.col("_n") / window) * window).alias("_used"))
    o = o.join(full, key).filter(F.col("ordinal") < F.col("_used"))
    o = o.withColumn("pos", (F.col("ordinal") % window).cast("int")).filter(F.col("pos") < keep)
    pooled = o.groupBy(key, "pos").agg(F.avg(F.col(value).cast("double")).alias("value"))
    if out_len > keep:  # zero padding (positions the windows never filled)
        pads = full.select(key, F.explode(F.sequence(F.lit(keep), F.lit(out_len - 1))).alias("pos"))
        pooled = pooled.unionByName(pads.withColumn("value", F.lit(0.0)))
    return pooled


def to_arrays(long_df: DataFrame, key: str, pos: str = "pos", value: str = "value", out: str = "features") -> DataFrame:
    """Long form → ``(key, array<double>)`` ordered by position (rows per key are bounded by the
    feature length, a parameter)."""
    return long_df.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(pos, value))), lambda s: s[value]).alias(out))


def feature_outcome(signals: DataFrame, key: str, window: int) -> DataFrame:
    """A11 for M17: how many keys produced features (at least one full window) of all keys."""
    per_key = signals.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") >= window).alias("succeeded"), F.count(F.lit(1)).alias("attempted"))


def mean_vectors(df: DataFrame, key: str, vec_col: str) -> DataFrame:
    """Element-wise mean per ``key`` in long form ``(key, pos, value)`` (partial aggregate on
    (key, pos); no vector is collected)."""
    e = df.select(key, F.posexplode(vec_col).alias("pos", "x"))
    return e.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("value"))


def dimension_variance(df: DataFrame, vec_col: str, targets=(0.95, 0.99)) -> tuple[DataFrame, DataFrame]:
    """A12/W1/T5 on coordinates: per-position sample variance, its share of the total, the running share
    in decreasing order of variance, and for each target the number of leading positions whose running
    share first exceeds it (strict ``>``, Q22).  The windows run over d rows (one per coordinate)."""
    e = df.select(F.posexplode(vec_col).alias("pos", "x"))
    v = e.groupBy("pos").agg(F.var_samp(F.col("x").cast("double")).alias("variance"))
    v = v.withColumn("share", F.col("variance") / F.sum("variance").over(Window.partitionBy()))
    order = Window.orderBy(F.col("variance").desc(), F.col("pos"))
    v = v.withColumn("order", F.row_number().over(order).cast("bigint"))
    v = v.withColumn("cum_share", F.sum("share").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = [F.struct(F.lit(float(t)).alias("target"),
                       F.min(F.when(F.col("cum_share") > F.lit(float(t)), F.col("order"))).alias("n_components"))
              for t in targets]
    counts = v.agg(F.array(*firsts).alias("_t")).select(F.inline("_t"))
    return v, counts


@dataclass
class Reduction:
    """M15 result: a fitted centring + PCA pipeline with all d components, the explained-variance
    ratios and the number ``n`` of leading components kept."""

    model: object
    ratios: list
    n: int
    vec_col: str

    def transform(self, df: DataFrame, out_col: str = "reduced") -> DataFrame:
        """Apply to new rows; keeps the first ``n`` components."""
        from pyspark.ml.functions import vector_to_array

        t = self.model.transform(df.withColumn("_features", _vec(self.vec_col)))
        return t.withColumn(out_col, F.slice(vector_to_array("_pca"), 1, self.n)).drop("_features", "_centred", "_pca")

    def save(self, path: str) -> None:
        """S9."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = _spark()
        spark.createDataFrame([(self.n, self.vec_col, [float(r) for r in self.ratios])],
                              "n int, vec_col string, ratios array<double>").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(path: str) -> "Reduction":
        from pyspark.ml import PipelineModel

        m = _spark().read.parquet(f"{path}/meta").first()
        return Reduction(PipelineModel.load(f"{path}/model"), list(m["ratios"]), m["n"], m["vec_col"])


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def _vec(col: str):
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(col).cast("array<double>"))


def fit_reduction(df: DataFrame, vec_col: str, variance: float = 0.99, n_components: int | None = None) -> Reduction:
    """Centre (``StandardScaler(withMean=True, withStd=False)``; Spark's PCA alone does not centre)
    and fit PCA with all d components; keep the smallest n whose cumulative explained-variance ratio
    is greater than ``variance`` (or exactly ``n_components``).  The d×d covariance is formed by a
    distributed aggregate and decomposed on the driver: right for d up to a few thousand."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler

    d = df.select(F.max(F.size(vec_col))).first()[0]
    pipe = Pipeline(stages=[StandardScaler(inputCol="_features", outputCol="_centred", withMean=True, withStd=False),
                            PCA(k=d, inputCol="_centred", outputCol="_pca")])
    model = pipe.fit(df.select(_vec(vec_col).alias("_features")))
    ratios = list(model.stages[-1].explainedVariance.toArray())
    if n_components is None:
        n_components = components_for(ratios, variance)
    return Reduction(model, ratios, int(n_components), vec_col)


def components_for(ratios, target: float) -> int:
    """T5 on d ratios (driver-side, d numbers): smallest n with cumulative ratio > target."""
    total = 0.0
    for i, r in enumerate(ratios):
        total += r
        if total > target:
            return i + 1
    return len(ratios)


def project_2d(df: DataFrame, vec_col: str, i: int, j: int, id_col: str) -> DataFrame:
    """Two chosen components as a table (0-based)."""
    return df.select(id_col, F.element_at(vec_col, i + 1).cast("double").alias("x"),
                     F.element_at(vec_col, j + 1).cast("double").alias("y"))
