"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are aggregates and equi-joins on a node.  A node with very many links (the hub of a star) is combined before
the shuffle, and its smallest neighbour is broadcast: there are at most ``HUBS`` such nodes, since each has at least
``1 / HUBS`` of the links.  The others join by shuffle.  Each round is written to the shared checkpoint folder, so a lost
executor costs at most one round.  Nothing but one row of totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.sources.scratch import materialize


HUBS = 5000
HUB_LINKS = 500  # a node with fewer is never a hub


def _with_lowest(edges: DataFrame, low: DataFrame, links: int) -> DataFrame:
    """``edges`` with the number ``m`` that ``low`` (``a, m, n``; n: links of a) has for ``a``."""
    most = max(HUB_LINKS, 2 * links // HUBS)
    hubs = F.broadcast(low.filter(F.col("n") > most).select("a", "m"))
    return edges.join(hubs, "a").unionAll(
        edges.join(hubs.select("a"), "a", "left_anti").join(low.filter(F.col("n") <= most).select("a", "m"), "a"))


def _large_star(e: DataFrame, links: int) -> DataFrame:
    both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return _with_lowest(both, low, links).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, links: int) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    return (_with_lowest(down, low, links).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(low.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; label is the smallest node of its component.
    Nodes without links do not appear.  Self-links and repeated links are allowed."""
    e = materialize(edges.select("a", "b").filter("a <> b").distinct(), "components")
    state, links = None, e.count()
    for _ in range(max_rounds):
        # a large step gives at most one link for each of its own, so their number bounds both steps
        e = materialize(_small_star(_large_star(e, links), links).filter("a <> b").distinct(), "components")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:  # a fixed point: every node points at its component's smallest node
            break
        state, links = now, now[0]
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
