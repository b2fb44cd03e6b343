"""What is looked at next: filters of scanned files, files that need review, samples, look-ups of hashes and registry rows by fallbacks, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.patterns import relative, uuid8
from lamina.functions.scalar import base_name, clean, segments
from lamina.operators.match import numbered

#: What a staging folder holds besides files to merge.
STAGING_FILES = ["pipeline_state.json", "staging_info.json", "processing_summary.csv", "llm_cache.json", "deferred_decisions.json"]
STAGING_FOLDERS, REGISTRIES, DUPLICATE_REGISTRY = ["logs", "__pycache__"], "registries", "Duplicados/duplicados_registro.xlsx"


def needs_review(file_type: Column, specimen: Column, collection: Column) -> Column:
    """Images of which the specimen or the collection is not known."""
    return F.coalesce(file_type == "image", F.lit(False)) & (clean(specimen).isNull() | clean(collection).isNull())


def select(files: DataFrame, kind: str | None = None, collection: str | None = None, review: bool | None = None, duplicate: bool | None = None) -> DataFrame:
    """Files of a type, of a collection, that need review or not, that are duplicates or not; conditions that are not given do not count."""
    tests = []
    if kind is not None:
        tests.append(F.col("type") == kind)
    if collection is not None:
        tests.append(F.col("collection") == collection)
    if review is not None:
        tests.append(F.coalesce("needs_review", F.lit(False)) == review)
    if duplicate is not None:
        tests.append(F.coalesce("is_duplicate", F.lit(False)) == duplicate)
    return files.filter(reduce(lambda a, b: a & b, tests)) if tests else files


def is_staged_file(rel: Column) -> Column:
    """Whether a file below a staging folder is one to merge: no metadata, log or registry."""
    parts = segments(rel)
    top = F.get(parts, F.lit(0))
    alone = (F.size(parts) == 1) & top.isin(STAGING_FILES)
    return ~(alone | top.isin([*STAGING_FOLDERS, REGISTRIES]) | (F.array_join(parts, "/") == DUPLICATE_REGISTRY))


def sample(rows: DataFrame, reviews: DataFrame, key: str, n: int, seed: int | None = None, duplicates: DataFrame | None = None, missing: list[str] | None = None) -> DataFrame:
    """At most n rows without a review, in the order of the key, or in a seeded one.

    duplicates: only rows that have one, by (key). missing: only rows that lack one of these fields at least.
    """
    out = rows.join(reviews.select(key).distinct(), key, "left_anti")
    if duplicates is not None:
        out = out.join(duplicates.select(key).distinct(), key, "left_semi")
    if missing:
        out = out.filter(reduce(lambda a, b: a | b, [clean(F.col(c).cast("string")).isNull() for c in missing]))
    return out.orderBy(*([F.xxhash64(F.lit(seed), F.col(key))] if seed is not None else []), key).limit(n)


def _first_found(rows: DataFrame, key: str, steps: list[DataFrame], values: list[str]) -> DataFrame:
    """Rows with `values` of the first step (rows of key and values) that has them, and its number from 1."""
    tagged = [df.select(F.col(key).alias("_k"), F.struct(F.lit(n).alias("step"), F.struct(*[F.col(v) for v in values]).alias("v")).alias("m")) for n, df in enumerate(steps, 1)]
    best = reduce(DataFrame.unionByName, tagged).groupBy("_k").agg(F.min("m").alias("m"))
    return rows.join(best, rows[key] == best["_k"], "left").select(*[rows[c] for c in rows.columns], *[F.col(f"m.v.{v}").alias(v) for v in values], F.col("m.step").alias("step"))


def hashes_of(files: DataFrame, hashes: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Files with md5_hash, phash and step: by the short id in the file name, else by the path below `root`, else by the whole path.

    Of several hash rows of an id or a path the least values count. Each hash row is looked up once by each way, so no two tables meet by all pairs.
    """
    told = hashes.select(F.lower(clean(F.col("uuid"))).alias("id"), clean(F.col("file_path")).alias("at"), "md5_hash", "phash")
    one = lambda c: told.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.min(F.struct("md5_hash", "phash")).alias("h")).select("_v", "h.*")
    ways = [(uuid8(F.col(path)), one("id")), (relative(F.col(path), root), one("at")), (F.col(path), one("at"))]
    keys = files.select(path).distinct()
    steps = [keys.withColumn("_v", way).join(table, "_v") for way, table in ways]
    return _first_found(files, path, steps, ["md5_hash", "phash"])


def registry_rows(wanted: DataFrame, registry: DataFrame, hashes: DataFrame, path: str = "path", key: str = "uuid") -> DataFrame:
    """(wanted columns, key found, step): the registry row of each file (path, md5_hash, id).

    1: a path of the row is the file's; 2: a path of the row ends in the file's name; 3: a hash row with the file's digest tells a path of the row;
    4: the file's own id is the row's. Of several the least key. By name each registry name is one row, however many files have it.
    """
    columns = [c for c in ("original_path", "current_path", "file_path") if c in registry.columns]
    listed = reduce(DataFrame.unionByName, [registry.select(F.col(key).cast("string").alias(key), clean(F.col(c)).alias("_v")) for c in columns]).filter(F.col(key).isNotNull() & F.col("_v").isNotNull())
    least = lambda df: df.groupBy("_v").agg(F.min(key).alias(key))
    by_path, by_name = least(listed), least(listed.withColumn("_v", base_name(F.col("_v"))))
    told = hashes.filter(clean(F.col("md5_hash")).isNotNull()).select(F.col("md5_hash").alias("_d"), F.col("file_path").alias("_v")).join(by_path, "_v").groupBy(F.col("_d").alias("_v")).agg(F.min(key).alias(key))
    own = registry.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct().withColumn("_v", F.col(key))
    ways = [(F.col(path), by_path), (base_name(F.col(path)), by_name), (F.col("md5_hash"), told), (F.col("id").cast("string"), own)]
    keys = wanted.groupBy(path).agg(F.min("md5_hash").alias("md5_hash"), F.min("id").alias("id"))
    steps = [keys.withColumn("_v", way).join(table, "_v") for way, table in ways]
    return _first_found(wanted, path, steps, [key])


def neighbours_in_order(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Rows with previous and next: the key (the last column of the order) of the row before and behind it in its group.

    Places are numbered by ranges of the order and joined by number, so a group of any size is spread over tasks.
    """
    key = order[-1]
    placed = numbered(rows, group, *order)
    side = lambda d, name: placed.select(F.col(group).alias("_g"), (F.col("rn") + d).alias("_at"), F.col(key).alias(name))
    out = placed
    for d, name in ((1, "previous"), (-1, "next")):
        s = side(d, name)
        out = out.join(s, (out["rn"] == s["_at"]) & out[group].eqNullSafe(s["_g"]), "left").drop("_g", "_at")
    return out.drop("rn")


def pages(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """Rows with the number of their page, from 1, in a total order."""
    return numbered(rows, *order).withColumn("page", F.ceil(F.col("rn") / size).cast("long"))


def success(rows: DataFrame, group: str, matched: Column) -> DataFrame:
    """(group, n, n_matched, rate): how often something was found."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(matched).alias("n_matched"))
    return g.withColumn("rate", F.col("n_matched") / F.col("n"))


def uuid_hashes(rows: DataFrame) -> DataFrame:
    """(uuid, phash, md5_hash) of a hash registry whose columns go by other names too; blank ids are left out, blank hashes are empty, of repeated ids the greatest values stay."""
    named = {c.lower(): c for c in rows.columns}
    pick = lambda *names: next((F.col(f"`{named[n]}`").cast("string") for n in names if n in named), F.lit(None).cast("string"))
    out = rows.select(clean(pick("uuid", "id")).alias("uuid"), F.coalesce(pick("phash", "p_hash", "phash_value"), F.lit("")).alias("phash"), F.coalesce(pick("md5_hash", "md5", "md5hash"), F.lit("")).alias("md5_hash"))
    return out.filter("uuid IS NOT NULL").groupBy("uuid").agg(F.max(F.struct("phash", "md5_hash")).alias("h")).select("uuid", "h.*")
