"""Connected components of an edge table by alternating large and small stars.

Every round is two shuffles of at most as many edges as there were; a hub's neighbours are
reduced to their minimum map-side, and the minima of hubs (at most ``2 / HUB_SHARE`` of them)
are broadcast, so that their edges are not shuffled to one task.  Rounds are written to the
shared folder, so a lost executor costs one round's task at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import materialize


#: Share of all edges from which a node is a hub.
HUB_SHARE = 1 / 1000


def _with_low(e: DataFrame, low: DataFrame, hub_from: float) -> DataFrame:
    """e (a, b) with each a's m of low (a, m, n); n is the node's number of edges."""
    hubs = F.broadcast(low.filter(F.col("n") >= hub_from).select("a", F.col("m").alias("hub_m")))
    marked = e.join(hubs, "a", "left")
    others = marked.filter("hub_m is null").select("a", "b").join(low.filter(F.col("n") < hub_from).select("a", "m"), "a")
    return marked.filter("hub_m is not null").select("a", "b", F.col("hub_m").alias("m")).unionByName(others)


def _large_star(e: DataFrame, hub_from: float) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    return _with_low(both.filter("b > a"), low, hub_from).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))


def _small_star(e: DataFrame, hub_from: float) -> DataFrame:
    """e: a > b."""
    low = e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = _with_low(e, low, hub_from).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, hub_share: float = HUB_SHARE) -> DataFrame:
    """edges (a, b) -> (a, root) for every node that has an edge and isn't its component's
    smallest node itself."""
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        # written between the stars, whose joins read their input twice
        e = materialize(_large_star(e, hub_share * e.count()), "large")
        e = materialize(_small_star(e, hub_share * e.count()), "stars")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return e.withColumnRenamed("b", "root")
        mark = now
