"""Feature queries: windowed signal features over ``events``, vector shaping over ``embeddings``,
per-label mean vectors, coordinate variance profile, PCA checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklight.functions import vectors as V
from ranklight.operators import features, neighbours, wide
from ranklight.plans.catalog import r6, register, table
from ranklight.plans.vector_queries import K_VEC, PAIRS_L2, _knn_sql, _knn_out

WIN, WIN_LEN, OUT_LEN = 8, 6, 10


@register("m17_signal_features",
          "WITH o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal, "
          "count(*) OVER (PARTITION BY user_id) AS cnt FROM events),\n"
          f"f AS (SELECT user_id, (ordinal % {WIN})::INTEGER AS pos, value FROM o WHERE cnt >= {WIN} "
          f"AND ordinal < (cnt // {WIN}) * {WIN} AND ordinal % {WIN} < {min(WIN, WIN_LEN, OUT_LEN)}),\n"
          "m AS (SELECT user_id, pos, avg(value) AS value FROM f GROUP BY user_id, pos),\n"
          f"p AS (SELECT DISTINCT user_id FROM o WHERE cnt >= {WIN})\n"
          "SELECT user_id, pos, round(value, 6) AS value FROM m UNION ALL "
          f"SELECT user_id, r.pos::INTEGER AS pos, 0.0 AS value FROM p, (SELECT unnest(range({min(WIN, WIN_LEN)}, {OUT_LEN})) AS pos) r")
def m17_signal_features(spark, sf_dir):
    """Per user, the value series ordered by (ts, event_id) cut into full windows of 8,
    each cut to 6, averaged over windows, padded to 10."""
    ev = table(spark, sf_dir, "events")
    out = features.signal_features(ev, "user_id", ["ts", "event_id"], "value", WIN, WIN_LEN, OUT_LEN)
    return out.select("user_id", "pos", r6("value").alias("value"))


@register("a11_feature_outcome",
          f"SELECT count_if(n >= {WIN})::BIGINT AS succeeded, count(*)::BIGINT AS attempted "
          "FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)")
def a11_feature_outcome(spark, sf_dir):
    return features.feature_outcome(table(spark, sf_dir, "events"), "user_id", WIN)


ARR_W, ARR_SEG, ARR_OUT = 24, 20, 30


@register("f12_f13_f9_array_features",
          "WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS p, "
          "len(embedding) AS d FROM embeddings),\n"
          "pk AS (SELECT vec_id, max(abs(x)) AS peak FROM e GROUP BY vec_id),\n"
          f"w AS (SELECT e.vec_id, e.p // {ARR_W} AS i, e.p % {ARR_W} AS j, coalesce(e.x / nullif(pk.peak, 0), 0.0) AS y, "
          f"e.d // {ARR_W} AS nfull FROM e JOIN pk USING (vec_id)),\n"
          f"m AS (SELECT vec_id, j AS pos, sum(y) / any_value(nfull) AS value FROM w WHERE i < nfull AND j < {ARR_SEG} "
          "GROUP BY vec_id, j),\n"
          f"pads AS (SELECT vec_id, unnest(range({min(ARR_W, ARR_SEG)}, {ARR_OUT})) AS pos, 0.0 AS value FROM embeddings)\n"
          "SELECT vec_id, pos::INTEGER AS pos, round(value, 6) AS value FROM m UNION ALL "
          "SELECT vec_id, pos::INTEGER, value FROM pads")
def f12_f13_f9_array_features(spark, sf_dir):
    """F12 → F13 → F9 per window → mean over windows → F9, all as array expressions, then exploded."""
    e = table(spark, sf_dir, "embeddings")
    # each stage is its own column, so later lambdas read it instead of re-deriving it per element
    e = e.select("vec_id", V.peak_normalize(F.col("embedding")).alias("y"))
    e = e.select("vec_id", V.full_windows(F.col("y"), ARR_W).alias("raw"))
    e = e.select("vec_id", F.transform("raw", lambda w: V.pad_or_cut(w, ARR_SEG)).alias("wins"))
    out = e.select("vec_id", V.pad_or_cut(V.mean_rows(F.col("wins"), ARR_SEG), ARR_OUT).alias("v"))
    return out.select("vec_id", F.posexplode("v").alias("pos", "value")).select("vec_id", "pos", r6("value").alias("value"))


@register("f10_f11_stacked_matrix",
          "WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS p, "
          "len(embedding) AS d FROM embeddings),\n"
          "a AS (SELECT vec_id, p // 16 AS r, p % 16 AS j, x FROM e WHERE p // 16 < d // 16),\n"
          "b AS (SELECT vec_id, (SELECT max(d // 16) FROM e) + p // 20 AS r, p % 20 AS j, x FROM e WHERE p // 20 < d // 20),\n"
          "cells AS (SELECT vec_id, r, j, x FROM a WHERE j < 18 UNION ALL SELECT vec_id, r, j, x FROM b WHERE j < 18 "
          "UNION ALL SELECT vec_id, r, j, 0.0 FROM (SELECT DISTINCT vec_id, r FROM a), (SELECT unnest(range(16, 18)) AS j))\n"
          "SELECT vec_id, (r * 18 + j)::INTEGER AS pos, round(x, 6) AS value FROM cells")
def f10_f11_stacked_matrix(spark, sf_dir):
    """F11 stacks the window matrices of widths 16 and 20; F10 pads/cuts every row to 18 and flattens."""
    e = table(spark, sf_dir, "embeddings")
    v = V.as_double(F.col("embedding"))
    m = V.pad_or_cut_rows(V.stack_rows(V.full_windows(v, 16), V.full_windows(v, 20)), 18)
    out = e.select("vec_id", F.posexplode(m).alias("pos", "value"))
    return out.select("vec_id", "pos", r6("value").alias("value"))


A9_SQL = ("WITH e AS (SELECT label, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, "
          "unnest(embedding)::DOUBLE AS x FROM embeddings) "
          "SELECT label, pos, round(avg(x), 6) AS value FROM e GROUP BY label, pos")


@register("a9_mean_vector_per_label", A9_SQL)
def a9_mean_vector_per_label(spark, sf_dir):
    m = features.mean_vectors(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return m.select("label", "pos", r6("value").alias("value"))


@register("f7_f8_distance_to_label_mean",
          "WITH e AS (SELECT label, (generate_subscripts(embedding, 1) - 1) AS pos, unnest(embedding)::DOUBLE AS x "
          "FROM embeddings), m AS (SELECT label, pos, avg(x) AS v FROM e GROUP BY label, pos), "
          "c AS (SELECT label, list(v ORDER BY pos) AS centre FROM m GROUP BY label) "
          "SELECT x.vec_id, round(list_distance(x.embedding::DOUBLE[], c.centre), 6) AS l2, "
          "round(power(list_distance(x.embedding::DOUBLE[], c.centre), 2), 6) AS sq_l2 "
          "FROM embeddings x JOIN c USING (label)")
def f7_f8_distance_to_label_mean(spark, sf_dir):
    """F7/F8 as Column expressions: each vector's distance to its label's mean vector."""
    e = table(spark, sf_dir, "embeddings")
    centres = features.to_arrays(features.mean_vectors(e, "label", "embedding"), "label", out="centre")
    j = e.join(centres, "label")
    return j.select("vec_id", r6(V.l2(F.col("embedding"), F.col("centre"))).alias("l2"),
                    r6(V.sq_l2(F.col("embedding"), F.col("centre"))).alias("sq_l2"))


VAR_SQL_BASE = ("WITH e AS (SELECT (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, unnest(embedding)::DOUBLE AS x "
                "FROM embeddings), v AS (SELECT pos, var_samp(x) AS variance FROM e GROUP BY pos), "
                "s AS (SELECT pos, variance, variance / sum(variance) OVER () AS share, "
                "row_number() OVER (ORDER BY variance DESC, pos)::BIGINT AS \"order\" FROM v), "
                "c AS (SELECT *, sum(share) OVER (ORDER BY \"order\" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
                "AS cum_share FROM s) ")


@register("a12_w1_variance_profile",
          VAR_SQL_BASE + "SELECT pos, round(variance, 6) AS variance, round(share, 6) AS share, \"order\", "
          "round(cum_share, 6) AS cum_share FROM c")
def a12_w1_variance_profile(spark, sf_dir):
    v, _ = features.dimension_variance(table(spark, sf_dir, "embeddings"), "embedding")
    return v.select("pos", r6("variance").alias("variance"), r6("share").alias("share"), "order",
                    r6("cum_share").alias("cum_share"))


@register("t5_components_for_variance",
          VAR_SQL_BASE + "SELECT t.target, min(\"order\") FILTER (WHERE cum_share > t.target) AS n_components "
          "FROM c, (VALUES (0.95::DOUBLE), (0.99::DOUBLE)) t(target) GROUP BY t.target")
def t5_components_for_variance(spark, sf_dir):
    _, counts = features.dimension_variance(table(spark, sf_dir, "embeddings"), "embedding", (0.95, 0.99))
    return counts


@register("m16_pca_full_knn", _knn_sql(PAIRS_L2, K_VEC))
def m16_pca_full_knn(spark, sf_dir):
    """Centred PCA keeping all components is a rotation, so kNN on the reduced vectors equals
    kNN on the originals (m8)."""
    e = table(spark, sf_dir, "embeddings")
    red = features.fit_reduction(e, "embedding", n_components=64).transform(e)
    q = red.select(F.col("vec_id").alias("query_id"), F.col("reduced").alias("embedding"))
    return _knn_out(neighbours.knn(red.select("vec_id", F.col("reduced").alias("embedding")), q, K_VEC))


@register("m15_pca_explained_variance")
def m15_pca_explained_variance(spark, sf_dir):
    """M15/A12/W1/T5 with real principal components: ratios, running total, components kept at 0.99.
    Eigenvectors have no SQL twin (rows-only); the tests check the invariants."""
    e = table(spark, sf_dir, "embeddings")
    red = features.fit_reduction(e, "embedding", variance=0.99)
    rows = [(i, float(r)) for i, r in enumerate(red.ratios)]
    # d rows (metadata of the fitted model), running total as a window over them
    df = spark.createDataFrame(rows, "component int, ratio double")
    from pyspark.sql import Window
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cum_ratio", F.sum("ratio").over(w)).withColumn("kept", F.col("component") < F.lit(red.n))


@register("m15_wide_captured",
          "SELECT round(sum(v), 6) AS total_variance, 1.0::DOUBLE AS captured, count(*)::INTEGER AS components FROM (SELECT var_samp(x) AS v FROM "
          "(SELECT generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY pos)")
def m15_wide_captured(spark, sf_dir):
    """M15/A12 by the range finder: the total variance, and the share that all components capture."""
    red = wide.fit(table(spark, sf_dir, "embeddings"), "embedding", components=64)
    return spark.range(1).select(F.round(F.lit(red.total_variance), 6).alias("total_variance"),
                                 F.round(F.lit(float(sum(red.ratios))), 9).alias("captured"), F.lit(red.n).alias("components"))


@register("m18_projection_2d", "SELECT vec_id, round(embedding[4]::DOUBLE, 6) AS x, round(embedding[5]::DOUBLE, 6) AS y FROM embeddings")
def m18_projection_2d(spark, sf_dir):
    p = features.project_2d(table(spark, sf_dir, "embeddings"), "embedding", 3, 4, "vec_id")
    return p.select("vec_id", r6("x").alias("x"), r6("y").alias("y"))


def _signal_sql(key: str, out: str) -> str:
    """CTE ``out(id, pos, value)``: M17 for every ``key`` of events."""
    return (
        f"{out}_o AS (SELECT {key} AS id, value, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) - 1 AS ordinal, "
        f"count(*) OVER (PARTITION BY {key}) AS cnt FROM events),\n"
        f"{out} AS (SELECT id, ordinal % {WIN} AS pos, avg(value) AS value FROM {out}_o WHERE cnt >= {WIN} "
        f"AND ordinal < (cnt // {WIN}) * {WIN} AND ordinal % {WIN} < {min(WIN, WIN_LEN, OUT_LEN)} GROUP BY ALL)")


MEDIA_RADIUS = 25.0
MEDIA_SQL = (f"WITH {_signal_sql('user_id', 'c')},\n{_signal_sql('event_type', 'q')},\n"
             "pairs AS (SELECT q.id AS query_id, c.id AS vec_id, sqrt(sum((q.value - c.value) * (q.value - c.value))) AS dist "
             "FROM q JOIN c USING (pos) GROUP BY q.id, c.id)\n")
MEDIA_COLS = "query_id, vec_id, format('user {:d}', vec_id) AS name, 'media/' || format('user {:d}', vec_id) AS path, round(dist, 6) AS dist"


def _media_search(spark, sf_dir, **how):
    """M17 -> M15/M16 -> S9 -> M14: features of every user's series are reduced and searched; a query is the
    raw feature vector of an event type's series, reduced inside the search with the model as it was stored.
    With all components kept, distances are those of the raw features, which SQL can check."""
    import uuid

    from ranklight.session import checkpoint_dir

    ev = table(spark, sf_dir, "events")

    def vectors(key: str, name: str):
        long = features.signal_features(ev, key, ["ts", "event_id"], "value", WIN, WIN_LEN, OUT_LEN)
        return features.to_arrays(long, key, out=name).withColumnRenamed(key, "id")

    media = vectors("user_id", "features")
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranklight/reduction-{uuid.uuid4().hex}"
    features.fit_reduction(media, "features", n_components=OUT_LEN).save(path)
    red = features.Reduction.load(path)
    coll = red.transform(media, "embedding").select(F.col("id").alias("vec_id"), "embedding")
    names = coll.select("vec_id", F.format_string("user %d", "vec_id").alias("name"))
    asked = vectors("event_type", "embedding").withColumn("query_id", F.xxhash64("id"))
    hits = neighbours.vector_search(coll, asked.select("query_id", "embedding"), names=names, reduction=red, **how)
    out = hits.join(asked.select("query_id", F.col("id").alias("kind")), "query_id")
    return out.select(F.col("kind").alias("query_id"), "vec_id", "name", "path", r6("dist").alias("dist"))


@register("m14_media_knn",
          MEDIA_SQL + f"SELECT {MEDIA_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), vec_id) "
          f"AS rank FROM pairs) WHERE rank <= {K_VEC}")
def m14_media_knn(spark, sf_dir):
    return _media_search(spark, sf_dir, k=K_VEC, is_knn=True)


@register("m14_media_range", MEDIA_SQL + f"SELECT {MEDIA_COLS} FROM pairs WHERE dist <= {MEDIA_RADIUS}")
def m14_media_range(spark, sf_dir):
    return _media_search(spark, sf_dir, radius=MEDIA_RADIUS, is_knn=False)
