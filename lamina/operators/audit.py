"""Audits of a curated folder against its registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.functions.scalar import clean, segments
from lamina.sources.snapshots import written

#: Folders that are no collection.
SPECIAL = ["Duplicados", "registries", "logs", "Archivos_Texto", "Otros_Archivos", "Revision_Manual", "__pycache__"]


def is_special(rel: Column) -> Column:
    return F.get(segments(rel), F.lit(0)).isin(SPECIAL)


def structure_kind(rel: Column, file_type: Column) -> Column:
    """What a file below the output folder counts as: main, duplicate, text or other; null where it does not count.

    Of collections and of Revision_Manual only images count; texts only where they are in their folder or among duplicates.
    """
    top, inside = F.get(segments(rel), F.lit(0)), F.size(segments(rel)) > 1
    image, text = F.coalesce(file_type == "image", F.lit(False)), F.coalesce(file_type == "text", F.lit(False))
    kind = (
        F.when(top == "Duplicados", F.when(image, "duplicate").when(text, "text").otherwise("other"))
        .when(top == "Archivos_Texto", F.when(text, "text").otherwise("other")).when(top == "Otros_Archivos", "other")
        .when(image & (~top.isin(SPECIAL) | (top == "Revision_Manual")), "main")
    )
    return F.when(inside, kind)


def structure(files: DataFrame, rel: str = "rel", file_type: str = "type") -> DataFrame:
    kind = structure_kind(F.col(rel), F.col(file_type))
    return files.select(kind.alias("kind")).filter("kind IS NOT NULL").groupBy("kind").agg(F.count("*").alias("n"))


def registry_counts(**registries: DataFrame) -> DataFrame:
    """(kind, n) of each registry and of all."""
    counts = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in registries.items()])
    return counts.unionByName(counts.agg(F.sum("n").alias("n")).select(F.lit("total").alias("kind"), "n"))


def discrepancies(found: DataFrame, told: DataFrame) -> DataFrame:
    """(kind, structure, registry, difference); kinds of either side."""
    both = found.withColumnRenamed("n", "structure").join(told.withColumnRenamed("n", "registry"), "kind", "full_outer").na.fill(0, ["structure", "registry"])
    return both.withColumn("difference", F.col("structure") - F.col("registry"))


def by_collection(files: DataFrame, rel: str = "rel") -> DataFrame:
    """(name, n) by first folder; of special ones only those with files of their own; registries in .xlsx do not count, but in the folders of texts and others."""
    top, sheet = F.get(segments(F.col(rel)), F.lit(0)), F.col(rel).endswith(".xlsx")
    counts = (F.size(segments(F.col(rel))) > 1) & F.when(top.isin("Archivos_Texto", "Otros_Archivos"), True).when((top == "Duplicados") | ~top.isin(SPECIAL), ~sheet).otherwise(False)
    return files.filter(counts).groupBy(top.alias("name")).agg(F.count("*").alias("n"))


def by_level(files: DataFrame, rel: str, level: int, first: int | None = None) -> DataFrame:
    """(name, n) by a folder below the collections; first: that many by name, not by count."""
    out = files.filter(~is_special(F.col(rel)) & (F.size(segments(F.col(rel))) > level + 1)).groupBy(F.get(segments(F.col(rel)), F.lit(level)).alias("name")).agg(F.count("*").alias("n"))
    return out.orderBy("name").limit(first) if first else out


def nested_levels(files: DataFrame, rel: str, *levels: int) -> DataFrame:
    parts = [F.get(segments(F.col(rel)), F.lit(k)).alias(f"level{k}") for k in levels]
    return files.filter(~is_special(F.col(rel)) & (F.size(segments(F.col(rel))) > max(levels) + 1)).groupBy(*parts).agg(F.count("*").alias("n"))


def duplicates_folder(files: DataFrame, rel: str = "rel", file_type: str = "type") -> DataFrame:
    own = files.filter(F.get(segments(F.col(rel)), F.lit(0)) == "Duplicados")
    return own.agg(F.count("*").alias("total"), F.count_if(F.col(file_type) == "image").alias("images"), F.count_if(F.coalesce(F.col(file_type) != "image", F.lit(True))).alias("others"))


def taxonomy(columns: list[str], *registries: DataFrame) -> DataFrame:
    """(field, value): distinct cleaned labels of all registries."""
    cells = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), clean(F.col(c).cast("string")).alias("value")) for c in columns])).alias("r")).select("r.*")
    return reduce(DataFrame.union, [cells(df) for df in registries]).filter("value IS NOT NULL").distinct()


def integrity_report(main: DataFrame, hashes: DataFrame, duplicates: DataFrame, key: str, sample: int = 20) -> DataFrame:
    """(problem, n, first, passed): main rows without hash, hashes without main row, duplicates that have a hash, and all; the first keys of each."""
    rows = {"missing_hash": main.join(hashes, key, "left_anti"), "missing_row": hashes.join(main, key, "left_anti"), "leaked_duplicate": duplicates.join(hashes, key, "left_semi")}
    problems = written(reduce(DataFrame.unionByName, [df.select(F.lit(p).alias("problem"), F.col(key).cast("string").alias("key")) for p, df in rows.items()]))
    counted = problems.groupBy("problem").agg(F.count("*").alias("n"))
    # a limit that the plan knows: no task sends more keys of a problem than are shown
    first = problems.withColumn("r", F.row_number().over(W.partitionBy("problem").orderBy("key"))).filter(F.col("r") <= sample)
    first = first.groupBy("problem").agg(F.sort_array(F.collect_list("key")).alias("first"))
    kinds = main.sparkSession.createDataFrame([(p,) for p in rows], "problem string")
    out = kinds.join(counted, "problem", "left").join(first, "problem", "left")
    out = out.select("problem", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("first", F.array().cast("array<string>")).alias("first"))
    every = out.agg(F.lit("all").alias("problem"), F.sum("n").alias("n"), F.array().cast("array<string>").alias("first"))
    return out.unionByName(every).withColumn("passed", F.col("n") == 0)


def preservation_report(sources: dict[str, DataFrame], merged: DataFrame, duplicates: DataFrame, key: str) -> DataFrame:
    """(part, n): rows of each source, their distinct keys, merged keys, missing and new ones, and those missing that are duplicates.

    equal_totals: 1 if as many keys were merged as there were; preserved: 1 if all that are missing are duplicates; else 0.
    """
    distinct = reduce(DataFrame.union, [df.select(key) for df in sources.values()]).distinct()
    lost = distinct.join(merged, key, "left_anti")
    parts = {f"source_{k}": df for k, df in sources.items()} | {
        "distinct": distinct, "merged": merged.select(key).distinct(), "missing": lost, "new": merged.select(key).distinct().join(distinct, key, "left_anti"), "justified": lost.join(duplicates, key, "left_semi"),
    }
    counts = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(p).alias("part"), "n") for p, df in parts.items()])
    of = lambda p: F.coalesce(F.max(F.when(F.col("part") == p, F.col("n"))), F.lit(0))
    verdicts = counts.agg((of("distinct") == of("merged")).cast("long").alias("equal_totals"), (of("missing") == of("justified")).cast("long").alias("preserved"))
    return counts.unionByName(verdicts.select(F.explode(F.array(*[F.struct(F.lit(v).alias("part"), F.col(v).alias("n")) for v in ("equal_totals", "preserved")])).alias("r")).select("r.*"))


def scan_summary(files: DataFrame, size: str, file_type: str, digest: str) -> DataFrame:
    copies = F.count(digest) - F.count_distinct(digest)
    return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum(size), F.lit(0)).alias("total_size"), F.count_if(F.col(file_type) == "image").alias("n_images"), copies.alias("n_copies"))


def coverage(hashes: DataFrame, digest: str, phash: str) -> DataFrame:
    """Rows, rows without a perceptual hash, and digests and hashes that several rows have."""
    several = lambda c: hashes.filter(clean(F.col(c)).isNotNull()).groupBy(c).count().filter("count > 1").agg(F.count("*").alias(f"{c}_groups")).withColumn("one", F.lit(1))
    total = hashes.agg(F.count("*").alias("n"), F.count_if(clean(F.col(phash)).isNull()).alias("without_phash")).withColumn("one", F.lit(1))
    return total.join(several(digest), "one").join(several(phash), "one").drop("one")


def review_statistics(rows: DataFrame, reviews: DataFrame, key: str, verdict: str) -> DataFrame:
    """(verdict, n) of all rows, those without one as pending."""
    return rows.select(key).join(reviews.select(key, verdict), key, "left").groupBy(F.coalesce(clean(F.col(verdict)), F.lit("pending")).alias("verdict")).agg(F.count("*").alias("n"))


def by_folder(files: DataFrame, path: str, names: int = 20) -> DataFrame:
    """(folder, n, sample): files of each folder, with its first names; no more names than the sample leave a task."""
    folder, name = F.regexp_replace(path, r"[/\\][^/\\]*$", ""), F.regexp_extract(path, r"([^/\\]*)$", 1)
    rows = files.select(folder.alias("folder"), name.alias("name"))
    first = F.slice(F.array_sort(F.collect_set("name")), 1, names)
    tagged = rows.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(64)))
    part = tagged.groupBy("folder", "salt").agg(F.count("*").alias("n"), first.alias("s"))
    return part.groupBy("folder").agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("s"))), 1, names).alias("sample"))
