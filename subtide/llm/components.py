"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.store import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); component is the smallest node reached.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the links no
    longer change. No step makes more rows than there are links, and the minimum of a node's
    neighbours is aggregated before the shuffle, so a node with very many links is no burden.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)))
        after = _mark(edges)
        if after == before:
            return edges.selectExpr("u AS node", "v AS component").unionByName(
                edges.selectExpr("v AS node", "v AS component").distinct()
            )
        before = after


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of them and itself."""
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
    return linked.selectExpr("e.v AS u", "e.m AS v").where("u <> v").distinct()
