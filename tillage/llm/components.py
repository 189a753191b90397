"""Connected components of a link table, by alternating stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.session import materialize


def _print(edges: DataFrame) -> tuple:
    """Number and two sums of hashes of the links: equal for equal tables."""
    h = [F.try_sum(F.shiftright(F.xxhash64(F.lit(i), "u", "v"), 20)) for i in (1, 2)]
    return tuple(edges.agg(F.count("*"), *h).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the label is the smallest node reachable.

    Every node's larger neighbours are hung on its smallest one, then its smaller ones, until
    nothing changes. The number of links never grows and the rounds grow with the logarithm of
    the longest path. A hub costs one partial minimum per task and a skew-split join.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _print(edges)
    while state[0]:
        # each node's neighbourhood minimum, over both directions
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        before, state = state, _print(edges)
        if before == state:
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("label"))
    roots = edges.select("v").distinct().join(stars.select(F.col("u").alias("v")), "v", "left_anti")
    return stars.select(F.col("u").alias("node"), "label").unionAll(roots.select(F.col("v").alias("node"), F.col("v").alias("label")))
