import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from ranklight.functions import vectors as V
from ranklight.operators import features, tables


def test_g5_windows_mean_pad_cut(spark):
    df = spark.createDataFrame([(0, [float(x) for x in range(1, 11)])], "k bigint, v array<double>")
    r = df.select(V.full_windows(F.col("v"), 4).alias("w")).first().w
    assert r == [[1, 2, 3, 4], [5, 6, 7, 8]]
    sig = spark.createDataFrame([(0, i, float(i + 1)) for i in range(10)], "k bigint, t bigint, value double")
    arr = features.to_arrays(features.signal_features(sig, "k", ["t"], "value", 4, 4, 6), "k").first().features
    assert arr == [3.0, 4.0, 5.0, 6.0, 0.0, 0.0]
    arr = features.to_arrays(features.signal_features(sig, "k", ["t"], "value", 4, 4, 3), "k").first().features
    assert arr == [3.0, 4.0, 5.0]


def test_short_signal_has_no_features(spark):
    sig = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "k bigint, t bigint, value double")
    assert features.signal_features(sig, "k", ["t"], "value", 4).count() == 0
    assert features.feature_outcome(sig, "k", 4).first().asDict() == {"succeeded": 0, "attempted": 1}
    df = spark.createDataFrame([(0, [1.0, 2.0])], "k bigint, v array<double>")
    assert df.select(V.full_windows(F.col("v"), 4).alias("w")).first().w == []


def test_g6_component_count():
    ratios = [0.6, 0.3, 0.08, 0.02]
    assert features.components_for(ratios, 0.95) == 3
    assert features.components_for(ratios, 0.99) == 4
    assert features.components_for(ratios, 0.5) == 1


def test_pca_all_components_preserve_distances(spark, sf001, tmp_path):
    e = spark.read.parquet(f"{sf001}/embeddings.parquet").orderBy("vec_id").limit(50)
    red = features.fit_reduction(e, "embedding", n_components=64)
    assert sum(red.ratios) == pytest.approx(1.0, abs=1e-9)
    out = red.transform(e).orderBy("vec_id").collect()
    a, b = out[0], out[1]
    d0 = math.dist(a.embedding, b.embedding)
    d1 = math.dist(a.reduced, b.reduced)
    assert d0 == pytest.approx(d1, abs=1e-9)
    red.save(str(tmp_path / "m"))
    again = features.Reduction.load(str(tmp_path / "m")).transform(e).orderBy("vec_id").collect()
    assert again[0].reduced == pytest.approx(out[0].reduced, abs=1e-12)


def test_ordinals_match_row_number(spark, sf001):
    ev = spark.read.parquet(f"{sf001}/events.parquet").select("user_id", "ts", "event_id")
    ours = tables.with_ordinal(ev, ["ts", "event_id"], ["user_id"], partitions=7)
    ref = ev.withColumn("ordinal", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("bigint"))
    assert ours.exceptAll(ref.select(*ours.columns)).count() == 0


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, -4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(V.l2(F.col("a"), F.col("b")).alias("l2"),
                  V.sq_l2(F.col("a"), F.col("b")).alias("sq"), V.peak_normalize(F.col("a")).alias("pk"),
                  V.pad_or_cut(F.col("a"), 3).alias("p"), V.in_box(F.col("a"), F.col("b"), 4).alias("box")).first()
    assert r.l2 == 5.0 and r.sq == 25.0 and r.pk == [0.75, -1.0] and r.p == [3.0, -4.0, 0.0] and r.box
