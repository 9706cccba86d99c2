"""Connected components of a link table by alternating large and small stars.

Each round joins every node to the smallest node it can see; the table of
links stays distributed and is written between rounds. A node with very many
links is one key of a map-side combined minimum and of a join that adaptive
execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``): root is the smallest node reachable."""
    edges = materialize(links.select("a", "b").filter("a <> b").distinct(), "cc_links")
    last = None
    while (state := _state(edges)) != last:
        last = state
        # large star: the larger neighbours of a node go to the smallest of it and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of these
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        down = materialize(down, "cc_large")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "cc_links")
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
