"""Connected components by alternating large-star and small-star, on edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import stage


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on a single one, and none that others hang on hangs itself."""
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.lit(c == "u").alias("hangs")) for c in "uv"])))
    uses = ends.groupBy("node").agg(F.count_if("hangs").alias("below"), F.count_if(~F.col("hangs")).alias("above"))
    return uses.where("below > 1 OR (below = 1 AND above > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (columns a, b); the root is the smallest node reachable.

    Large-star hangs every larger neighbour of a node on the smallest node it sees, small-star does so with the
    smaller neighbours; rounds end when the edges are stars, which takes about the logarithm of the longest path.
    Smallest neighbours come from partial aggregates, and a node with very many neighbours only makes its side of a
    join hot, which Spark splits, as the smallest neighbours are stored first. Loops, repeated edges and nulls in `edges` change nothing; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a <> b").distinct()
    edges = stage(edges, "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        smallest = stage(smallest, "smallest")
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large, "large-star")
        smallest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        moved = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(moved.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), "small-star")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
