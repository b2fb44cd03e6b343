"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import Tables, materialize


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of all nodes in the links (a, b); a component's name is its smallest node.

    Links stay in tables: each round aggregates and joins them, so no node's
    neighbours are ever gathered, and a star of any size is pre-aggregated.
    """
    with Tables() as tables:
        edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
        before = None
        for _ in range(most_rounds):
            both = edges.union(edges.select("v", "u"))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            old, edges = edges, materialize(small.select("e.*").filter("u <> v").distinct())
            tables.drop(old)
            now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        else:
            raise RuntimeError("components did not settle")
        tables.keep(edges)
        # settled: each node points at the smallest of its component
        return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
