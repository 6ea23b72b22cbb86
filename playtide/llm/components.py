"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtide.session import written


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the smallest node that can be reached.

    A round moves every node's larger neighbours, then its smaller ones, to its smallest neighbour; the rounds needed grow with
    the logarithm of the longest chain. Each round is written below the shared folder; the driver sees only counts and sums.
    A node with very many neighbours is aggregated with map-side combine and joined with Spark's own splitting of large keys.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    pairs, before = written(pairs, "component-edges"), None
    for _ in range(most_rounds):
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Larger neighbours of a go to m(a).
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        # Each node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = written(small.select("e.a", "e.b").filter("a != b").distinct(), "component-edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
