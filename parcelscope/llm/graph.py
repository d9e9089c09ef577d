"""Connected components over an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Each round points every node's larger neighbours at its smallest neighbour (large star), then
    every node and its smaller neighbours at the smallest of them (small star); edges
    become stars in a logarithmic number of rounds.  Minima are grouped aggregates with
    map-side combine, joined back by a join that can be split, so a hub needs no
    task of its own.  Each round is written to the shared folder.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        nxt = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        # stars only: no node is both a leaf and a centre
        if nxt.join(nxt.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty() \
                and nxt.groupBy("u").count().filter("count > 1").isEmpty():
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                nxt.select("v", "v").distinct())
        e = nxt
