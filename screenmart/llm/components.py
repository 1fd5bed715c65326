"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import stored


def components(links: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches.

    Alternates the large-star and small-star steps: each step is one aggregation
    per node, every pass at least keeps and in practice quickly shortens paths, and
    no neighbour list is ever gathered: a step needs only the smallest neighbour,
    an aggregate with partial sums, and an equi-join that adaptive execution may
    split. Links are stored after each pass. Nulls, loops and repeated links are
    ignored; no links give no rows. A node without links to others has no row.
    """
    edges = links.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        seen = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if seen == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = seen


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node link to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, link to the smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", "m")).distinct()
