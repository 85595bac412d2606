"""Connected components of a link table, by alternating large-star and
small-star steps.  Every step is a grouped minimum (combined before the
shuffle) joined back to its edges, so a vertex with very many links costs no
task more than its share: the join's large side can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over directed edges (u, v)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    low = low.select("w", F.least("w", "m").alias("m"))
    # a second key that the grouping doesn't have: both sides are dealt for the
    # join itself, and then a vertex with very many edges can be split
    near = both.join(low, (both["u"] == low["w"]) & (F.xxhash64(both["u"]) == F.xxhash64(low["w"])))
    if large:
        moved = near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.filter("u != v").distinct()
    # every smaller neighbour, and the vertex itself, now hangs on the minimum
    moved = near.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
    return moved.select("e.u", "e.v").filter("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (columns a, b; any
    order, repeats and self-links allowed); component is the smallest id
    reachable.  Vertices without links don't appear."""
    e = stored(edges.filter("a != b")
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "links")
    mark = _mark(e)
    while mark[0]:
        e = stored(_star(_star(e, large=True), large=False), "stars")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """What changes whenever an edge does."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
