"""Vector search queries: every ``embeddings`` row is a query against the whole table (a kNN graph /
radius join), the known-item pattern run for every item at once."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ranklight.operators import neighbours, pivots, zorder
from ranklight.plans.catalog import r6, register, table
from ranklight.session import checkpoint_dir

K_VEC = 5
RADIUS = 1.2          # Euclidean
RADIUS_SQ = 1.3       # squared Euclidean (its own unit, Q15)


def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def _as_queries(df):
    return df.select(F.col("vec_id").alias("query_id"), "embedding")


PAIRS_L2 = ("pairs AS (SELECT q.vec_id AS query_id, c.vec_id, "
            "list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS dist FROM embeddings q, embeddings c)")
PAIRS_SQ = ("pairs AS (SELECT q.vec_id AS query_id, c.vec_id, "
            "power(list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 2) AS dist FROM embeddings q, embeddings c)")


def _knn_sql(pairs: str, k: int) -> str:
    return (f"WITH {pairs} SELECT query_id, rank, vec_id, round(dist, 6) AS dist FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY query_id ORDER BY round(dist, 9), vec_id)::BIGINT AS rank FROM pairs) WHERE rank <= {k}")


def _range_sql(pairs: str, r: float) -> str:
    return f"WITH {pairs} SELECT query_id, vec_id, round(dist, 6) AS dist FROM pairs WHERE dist <= {r}"


def _knn_out(df):
    return df.select("query_id", "rank", "vec_id", r6("dist").alias("dist"))


def _range_out(df):
    return df.select("query_id", "vec_id", r6("dist").alias("dist"))


@register("m8_knn_exact_l2", _knn_sql(PAIRS_L2, K_VEC))
def m8_knn_exact_l2(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.knn(e, _as_queries(e), K_VEC, "l2"))


@register("m8_knn_exact_l2_blocked", _knn_sql(PAIRS_L2, K_VEC))
def m8_knn_exact_l2_blocked(spark, sf_dir):
    """Same query through the salted-cogroup strategy (small blocks)."""
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.knn(e, _as_queries(e), K_VEC, "l2", block_rows=128))


@register("m9_range_exact_l2", _range_sql(PAIRS_L2, RADIUS))
def m9_range_exact_l2(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.within(e, _as_queries(e), RADIUS, "l2"))


@register("m11_range_grid_l2", _range_sql(PAIRS_L2, RADIUS))
def m11_range_grid_l2(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.grid_within(e, _as_queries(e), RADIUS, "l2"))


@register("m11_range_grid_pca_l2", _range_sql(PAIRS_L2, RADIUS))
def m11_range_grid_pca_l2(spark, sf_dir):
    """M11 with grid cells on the three leading principal directions (M15) instead of raw coordinates."""
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.grid_within(e, _as_queries(e), RADIUS, "l2", axes="pca"))


@register("m12_knn_exact_sqeuclidean", _knn_sql(PAIRS_SQ, K_VEC))
def m12_knn_exact_sqeuclidean(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.knn(e, _as_queries(e), K_VEC, "sqeuclidean"))


@register("m13_range_exact_sqeuclidean", _range_sql(PAIRS_SQ, RADIUS_SQ))
def m13_range_exact_sqeuclidean(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.within(e, _as_queries(e), RADIUS_SQ, "sqeuclidean"))


@register("m10_knn_pivot", _knn_sql(PAIRS_L2, K_VEC))
def m10_knn_pivot(spark, sf_dir):
    """Exact kNN through the pivot index, built over the whole table: cells, rings, and the visits that bounds leave."""
    e = _emb(spark, sf_dir)
    return _knn_out(pivots.knn(pivots.build(e), _as_queries(e), K_VEC))


@register("m9_range_pivot_l2", _range_sql(PAIRS_L2, RADIUS))
def m9_range_pivot_l2(spark, sf_dir):
    """The radius join through the pivot index."""
    e = _emb(spark, sf_dir)
    return _range_out(pivots.within(pivots.build(e), _as_queries(e), RADIUS))


def _zindex(spark, sf_dir):
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranklight/zorder-{uuid.uuid4().hex}"
    zorder.save(_emb(spark, sf_dir), path)
    return zorder.load(spark, path)


BOX = 0.3  # half-width of the box around every query


@register("p10_box_query",
          "SELECT query_id, vec_id, round(dist, 6) AS dist FROM (SELECT q.vec_id AS query_id, c.vec_id, "
          "list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS dist, list_max([abs(q.embedding[i]::DOUBLE - c.embedding[i]::DOUBLE) FOR i IN "
          "range(1, len(q.embedding) + 1)]) AS far "
          f"FROM embeddings q, embeddings c) WHERE far <= {BOX}")
def p10_box_query(spark, sf_dir):
    """P10: for every vector, all vectors inside the box of half-width ``BOX`` around it, through the stored Z-order index."""
    e = _emb(spark, sf_dir)
    return _range_out(zorder.box(_zindex(spark, sf_dir), _as_queries(e), BOX))


@register("m11_range_zorder", _range_sql(PAIRS_L2, RADIUS))
def m11_range_zorder(spark, sf_dir):
    """M11 through the stored Z-order index."""
    e = _emb(spark, sf_dir)
    return _range_out(zorder.within(_zindex(spark, sf_dir), _as_queries(e), RADIUS))


@register("m14_vector_range_grid", _range_sql(PAIRS_L2, RADIUS))
def m14_vector_range_grid(spark, sf_dir):
    """M14's method switch, ``grid``: the radius search through the grid index."""
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.vector_search(e, _as_queries(e), radius=RADIUS, is_knn=False, method="grid"))


@register("m14_vector_search_flat", _knn_sql(PAIRS_SQ, K_VEC))
def m14_vector_search_flat(spark, sf_dir):
    """M14's method switch, ``flat``: squared distances."""
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.vector_search(e, _as_queries(e), K_VEC, method="flat"))


@register("m14_vector_search_pivot", _knn_sql(PAIRS_L2, K_VEC))
def m14_vector_search_pivot(spark, sf_dir):
    """M14's method switch, ``pivot``: exact kNN through the candidate index."""
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.vector_search(e, _as_queries(e), K_VEC, method="pivot"))


@register("m10_knn_lsh")
def m10_knn_lsh(spark, sf_dir):
    """Approximate: no SQL twin (recall against m8 is checked in the tests)."""
    e = _emb(spark, sf_dir)
    return _knn_out(neighbours.lsh_knn(e, _as_queries(e), K_VEC))


NAMES_SQL = "format('{:d} - label {:d}', vec_id, label)"


@register("m14_vector_search_named",
          f"WITH {PAIRS_L2}, hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), vec_id)"
          f"::BIGINT AS rank FROM pairs) SELECT h.query_id, h.rank, h.vec_id, {NAMES_SQL.replace('vec_id', 'e.vec_id')} AS name, "
          f"'media/' || {NAMES_SQL.replace('vec_id', 'e.vec_id')} AS path, round(h.dist, 6) AS dist "
          f"FROM hits h JOIN embeddings e ON e.vec_id = h.vec_id WHERE h.rank <= {K_VEC}")
def m14_vector_search_named(spark, sf_dir):
    e = _emb(spark, sf_dir)
    names = e.select("vec_id", F.format_string("%d - label %d", "vec_id", "label").alias("name"))
    hits = neighbours.vector_search(e, _as_queries(e), K_VEC, is_knn=True, method="sequential", names=names)
    return hits.select("query_id", "rank", "vec_id", "name", "path", r6("dist").alias("dist"))


@register("m14_vector_range_named",
          f"WITH {PAIRS_L2} SELECT h.query_id, h.vec_id, {NAMES_SQL.replace('vec_id', 'e.vec_id')} AS name, "
          f"'media/' || {NAMES_SQL.replace('vec_id', 'e.vec_id')} AS path, round(h.dist, 6) AS dist "
          f"FROM pairs h JOIN embeddings e ON e.vec_id = h.vec_id WHERE h.dist <= {RADIUS}")
def m14_vector_range_named(spark, sf_dir):
    """M14, range branch (J4, F14): every hit within the radius with its name and path."""
    e = _emb(spark, sf_dir)
    names = e.select("vec_id", F.format_string("%d - label %d", "vec_id", "label").alias("name"))
    hits = neighbours.vector_search(e, _as_queries(e), radius=RADIUS, is_knn=False, method="sequential", names=names)
    return hits.select("query_id", "vec_id", "name", "path", r6("dist").alias("dist"))


@register("t3_range_ordered", _range_sql(PAIRS_L2, RADIUS))
def t3_range_ordered(spark, sf_dir):
    """Range hits sorted by query and distance (a range-partitioned sort)."""
    e = _emb(spark, sf_dir)
    return _range_out(neighbours.order_hits(neighbours.within(e, _as_queries(e), RADIUS, "l2")))


@register("f17_float32", "SELECT vec_id, embedding::FLOAT[] AS embedding FROM embeddings")
def f17_float32(spark, sf_dir):
    """vectors widened for arithmetic and narrowed to float32 again."""
    from ranklight.functions.vectors import as_double, to_float32

    return _emb(spark, sf_dir).select("vec_id", to_float32(as_double(F.col("embedding"))).alias("embedding"))
