"""Connected components of an edge list, by alternating large-star and
small-star steps (each a group-by; a hub's neighbours are only combined by
``min``, never gathered)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large star) or the smaller-or-equal (small star)
    neighbours of every node to the smallest node around it."""
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    pairs = both.join(low, "u")
    if large:
        out = pairs.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = pairs.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is a centre or hangs on one centre."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return each.filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable.

    Nodes without an edge are not listed. Pairs with a null or with a = b are
    ignored; repeated and mirrored pairs count once; no pairs give no rows.
    The number of rounds grows with the logarithm of the longest path; each
    round is written to the shared folder. More than ``most_rounds`` rounds
    raise an error rather than return unfinished components.
    """
    now = written(edges.select("a", "b").filter(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", gathered=True)
    for _ in range(most_rounds):
        if _all_stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        nxt = written(_star(_star(now, True), False), "edges", gathered=True)
        remove(now)
        now = nxt
    raise RuntimeError("components did not converge")
