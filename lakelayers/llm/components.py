"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.scratch import stage


def component_roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node of an edge; the root is the smallest node of the component.

    Large-star and small-star steps alternate until the edges are the stars of the roots. A step
    replaces the edges of a node by as many edges to its smallest neighbour, so no step grows the
    table. Each round is a written table.
    """
    now = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).filter("v <> m").distinct()
    seen = None
    while True:
        now = stage(_small_star(_large_star(now)), "components")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m")), F.sum(F.crc32(F.concat_ws(",", "v", "m").cast("binary")).cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("m").alias("root")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("n")).union(edges.select(F.col("m"), F.col("v")))
    least = both.groupBy("u").agg(F.min("n").alias("least")).select(F.col("u").alias("centre"), F.least("u", "least").alias("m"))
    larger = edges.select(F.col("m").alias("u"), F.col("v"))  # the neighbours above u
    return larger.join(least, larger["u"] == least["centre"]).select("v", "m").filter("v <> m").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("m").alias("least")).withColumnRenamed("v", "centre")
    joined = edges.join(least, edges["v"] == least["centre"])
    lower = joined.select(F.col("m").alias("v"), F.col("least").alias("m"))
    own = least.select(F.col("centre").alias("v"), F.col("least").alias("m"))
    return lower.union(own).filter("v <> m").distinct()
