"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (longs u, v).

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour,
    with grouped minima and joins only: no neighbourhood is gathered in one place.  Rounds are written
    to the shared folder; their number grows with the logarithm of the longest path.
    """
    e = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpoint(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        e = checkpoint(small.distinct(), "small-star")
        last, mark = mark, _mark(e)
        if mark == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
