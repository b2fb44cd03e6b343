"""Exact and perceptual duplicate groups, and marking of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.sources.snapshots import written


def exact_groups(files: DataFrame, digest: Column, key: str, size: str) -> DataFrame:
    """Groups of equal content with more than one file; the largest file leads, the smallest key on ties. Keys are of any type that has an order."""
    g = files.select(digest.alias("digest"), F.col(key), F.col(size)).groupBy("digest")
    lead = F.min(F.struct(F.coalesce(-F.col(size), F.lit(1)).alias("s"), F.col(key).alias("k")))  # files of unknown size come last
    g = g.agg(F.count("*").alias("n_files"), lead.alias("lead"), F.min(key).alias("first_id"), F.sum(size).alias("total_size"))
    return g.filter("n_files > 1").select("digest", "n_files", F.col("lead.k").alias("primary_id"), "first_id", "total_size")


def duplicate_counts(files: DataFrame, digest: Column) -> DataFrame:
    """Files, groups, files beyond the first of each, and their ratio to the rest."""
    g = files.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"))
    g = g.agg(F.sum("n").alias("n_files"), F.count_if(F.col("n") > 1).alias("n_groups"), F.sum(F.col("n") - 1).alias("n_extra"))
    return g.withColumn("ratio", F.coalesce(F.try_divide(F.col("n_extra"), F.col("n_files") - F.col("n_extra")), F.lit(0.0)))


def perceptual_groups(files: DataFrame, phash: str, digest: str, key: str) -> DataFrame:
    """Groups of equal perceptual hash, without those that are wholly inside one exact group. A file without a digest is in none."""
    content = F.nullif(F.col(digest), F.lit(""))
    g = files.filter(F.col(phash).isNotNull()).groupBy(phash)
    g = g.agg(F.count("*").alias("n_files"), F.count_distinct(content).alias("n_contents"), F.min(key).alias("first_id"), F.count_if(content.isNull()).alias("_bare"))
    return g.filter("n_files > 1 AND (n_contents > 1 OR _bare > 0)").drop("_bare")


def mark_duplicates(files: DataFrame, digest: str, phash: str, key: str) -> DataFrame:
    """Each file with its duplicate_of (exact first, then perceptual among files not yet marked) and the root of that chain.

    Files without a digest or hash are no duplicates by it. The three columns are written once, and so are the links, which meet themselves.
    """
    files = written(files.select(key, digest, phash))
    exact = files.groupBy(digest).agg(F.min(key).alias("exact_of"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    one = files.join(exact, digest, "left").withColumn("exact_of", F.when(F.col("exact_of") != F.col(key), F.col("exact_of")))
    near = one.filter("exact_of IS NULL").groupBy(phash).agg(F.min(key).alias("near_of"))
    out = one.join(near, phash, "left").withColumn("near_of", F.when(F.col("exact_of").isNull() & (F.col("near_of") != F.col(key)), F.col("near_of")))
    kind = F.when(F.col("exact_of").isNotNull(), "exact").when(F.col("near_of").isNotNull(), "perceptual")
    out = written(out.select(key, F.coalesce("exact_of", "near_of").alias("duplicate_of"), kind.alias("duplicate_type")))
    # an exact original can itself point at a perceptual one, and that one at none: two steps reach the root
    step = out.select(F.col(key).alias("duplicate_of"), F.col("duplicate_of").alias("next"))
    return out.join(step, "duplicate_of", "left").select(key, "duplicate_of", "duplicate_type", F.coalesce("next", "duplicate_of", key).alias("root"))


def autofill(rows: DataFrame, group: str, key: str, field: str) -> DataFrame:
    """Per group: a single known value fills the gaps; several are a discrepancy and fill nothing."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_distinct(field).alias("kinds"), F.min(field).alias("only"), F.count_if(F.col(field).isNull()).alias("gaps"))
    g = g.filter("n > 1").withColumn("outcome", F.when(F.col("kinds") > 1, "discrepancy").when((F.col("kinds") == 1) & (F.col("gaps") > 0), "filled").otherwise("same"))
    return rows.join(g, group).select(key, field, "outcome", F.when(F.col("outcome") == "filled", F.coalesce(field, "only")).otherwise(F.col(field)).alias("resolved"))
