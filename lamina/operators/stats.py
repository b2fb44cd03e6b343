"""Distributions, completeness, hierarchies and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.scalar import clean


def distribution(df: DataFrame, value: Column, name: str, order: str | None = None) -> DataFrame:
    """(name, n). order: `count` (greatest first), `value` (numbers ascending, then texts, what is unknown among them), or none."""
    out = _distribution(df, value, name)
    if order == "count":
        return out.orderBy(F.desc("n"), name)
    if order == "value":
        number = F.col(name).try_cast("int")
        return out.orderBy(number.isNull(), number, name)
    return out


def _distribution(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(F.coalesce(clean(value.cast("string")), F.lit("Unknown")).alias(name)).agg(F.count("*").alias("n"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Filled and empty cells of each column, in one pass."""
    one = df.agg(F.count("*").alias("total"), *[F.count(clean(F.col(c).cast("string"))).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled"), (F.col("total") - F.col(c)).alias("empty")) for c in columns])).alias("r")).select("r.*")


def hierarchy(df: DataFrame, *levels: str) -> DataFrame:
    """Counts at each level of a hierarchy and in total."""
    return df.rollup(*levels).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def top_links(df: DataFrame, parent: str, child: str, k: int) -> DataFrame:
    """Links from parents to the k most frequent children, ties by name."""
    top = df.groupBy(child).agg(F.count("*").alias("n")).orderBy(F.desc("n"), child).limit(k).select(child)
    return df.join(F.broadcast(top), child, "left_semi").groupBy(parent, child).agg(F.count("*").alias("n"))


def flow_links(df: DataFrame, top: str, middle: str, low: str, k: int) -> DataFrame:
    """(level, parent, child, n): all links from top to middle, and those from middle to the k most frequent low ones, ties by name.

    Empty labels of the two lower levels are unknown within their parent, so they make no common node.
    """
    label = lambda c: F.coalesce(clean(F.col(c).cast("string")), F.lit("Unknown"))
    within = lambda c, p: F.when(F.col(c) == "Unknown", F.concat(F.lit("Unknown ("), F.col(p), F.lit(")"))).otherwise(F.col(c))
    rows = df.select(label(top).alias("a"), label(middle).alias("b"), label(low).alias("c"))
    rows = rows.withColumn("b", within("b", "a")).withColumn("c", within("c", "b"))
    level = lambda i, links: links.select(F.lit(i).alias("level"), *links.columns)
    first = rows.groupBy(F.col("a").alias("parent"), F.col("b").alias("child")).agg(F.count("*").alias("n"))
    second = top_links(rows.select(F.col("b").alias("parent"), F.col("c").alias("child")), "parent", "child", k)
    return level(1, first).unionByName(level(2, second))


def pivot_counts(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """A count for each value of `column`, 0 where there is none; values are given, so no pass looks for them."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"c{v}") for v in values])


def presence(df: DataFrame, value: Column) -> DataFrame:
    n = F.count(clean(value))
    return df.agg(n.alias("with_id"), (F.count("*") - n).alias("without_id"), F.round(F.try_divide(100.0 * n, F.count("*")), 4).alias("percent"))


def shared(df: DataFrame, value: Column) -> DataFrame:
    """Values used once and values used more than once."""
    g = df.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count("*").alias("n"))
    return g.agg(F.count_if(F.col("n") == 1).alias("used_once"), F.count_if(F.col("n") > 1).alias("used_more"))
