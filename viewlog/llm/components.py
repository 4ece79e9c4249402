"""Connected components of an edge table by large-star and small-star steps.

Each step relinks a node's neighbours to the smallest node in its
neighbourhood, halving path lengths, so the number of rounds follows the
logarithm of the longest path. Rounds are written to the shared work folder;
nothing but one count per round reaches the driver. The smallest neighbour is
a map-side minimum and joins back as an ordinary (skew-splittable) join, so a
hub with very many neighbours is never gathered. Where a count proves the links
few, the minima are broadcast instead, which saves the steps on small tables most
of their shuffles.

Defined results: self-loops and repeated edges are ignored, null nodes are
dropped, nodes without edges do not appear, an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import few
from viewlog.llm.common import hashes_written as written


def _least(pairs: DataFrame, small: bool) -> DataFrame:
    """Adds each node's least neighbour, itself included, as ``m``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(F.broadcast(least) if small else least, "a")


def _two_ways(a: str, b: str, c: str, d: str) -> Column:
    """Two links ``a, b`` from one row."""
    return F.explode(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(F.col(c).alias("a"), F.col(d).alias("b")))).alias("link")


def _large_star(edges: DataFrame, small: bool = False) -> DataFrame:
    both = edges.select(_two_ways("a", "b", "b", "a")).select("link.*")
    return _least(both, small).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame, small: bool = False) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    starred = _least(down if small else down.distinct(), small)
    return starred.select(_two_ways("b", "m", "a", "m")).select("link.*").where("a != b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with an edge."""
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    small = few(links)  # a step never makes more links than it gets
    while True:
        starred = written(_small_star(_large_star(links, small), small), "links")
        # Done when every node has one link and it leads to a root.
        roots = starred.select(F.col("b").alias("a")).distinct()
        inner = starred.join(F.broadcast(roots) if small else roots, "a", "left_semi").limit(1).count()
        many = 0 if inner else starred.groupBy("a").count().where("count > 1").limit(1).count()
        links = starred
        if not inner and not many:
            break
    own = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)
