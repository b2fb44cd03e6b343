"""Registries as tables: look-ups, updates, numbering, links between duplicates and their originals, path rewrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.patterns import relative, uuid8
from lamina.functions.scalar import base_name, clean, merge_lists, parent
from lamina.operators.match import numbered


def search(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows equal to all wanted values; names that are no column are ignored."""
    known = [F.col(c) == v for c, v in wanted.items() if c in rows.columns]
    return rows.filter(reduce(lambda a, b: a & b, known)) if known else rows


def lookup(rows: DataFrame, column: str, value: object, order: str) -> DataFrame:
    """The first row of a value, in a stated order."""
    return rows.filter(F.col(column) == value).orderBy(order).limit(1)


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key that is not blank: the last in the order; it combines before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    last = rows.filter(clean(F.col(key).cast("string")).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return last.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def upsert(rows: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows with those of `new` in place of rows with their key; of several the last in the order."""
    return latest(rows.unionByName(new, allowMissingColumns=True), key, order)


def update(rows: DataFrame, key: str, value: object, **changes: object) -> DataFrame:
    """Rows of a key with changed values; names that are no column are ignored."""
    hit = F.col(key) == value
    return rows.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in changes.items() if c in rows.columns})


def append(*registries: DataFrame) -> DataFrame:
    """All rows; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), registries)


def reorder(rows: DataFrame, first: list[str]) -> DataFrame:
    return rows.select(*[c for c in first if c in rows.columns], *[c for c in rows.columns if c not in first])


def greatest_number(ids: DataFrame, column: str, mark: str) -> DataFrame:
    """The greatest number of ids <mark><digits>, 0 without any."""
    return ids.agg(F.coalesce(F.max(F.regexp_extract(column, f"^{mark}([0-9]+)$", 1).try_cast("long")), F.lit(0)).alias("last"))


def with_ids(rows: DataFrame, taken: DataFrame, mark: str, column: str, *order: str) -> DataFrame:
    """Rows with ids <mark>%06d that go on behind the greatest of `taken`, in the order given."""
    last = greatest_number(taken, column, mark).first()["last"]
    return numbered(rows, *order, start=last).withColumn(column, F.format_string(f"{mark}%06d", "rn")).drop("rn")


def missing(rows: DataFrame, important: list[str]) -> Column:
    """Whether any important field is blank; one that is no column is blank in every row."""
    if any(c not in rows.columns for c in important):
        return F.lit(True)
    return reduce(lambda a, b: a | b, [clean(F.col(c).cast("string")).isNull() for c in important])


def probe(keys: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """For each key whether each table has it."""
    out = keys.select(key).distinct()
    for name, table in tables.items():
        out = out.join(table.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return rows.join(gone.select(key).distinct(), key, "left_anti")


def link_duplicates(duplicates: DataFrame, main: DataFrame, key: str = "uuid", paths: str = "original_path", current: str = "current_path") -> DataFrame:
    """(key, main, step): the original of each duplicate, or __unmatched__.

    Steps: a path that both list, the short id of the duplicate's current name, a
    short id in a path that it lists. Of several the first path in the list
    counts, and of several originals the greatest key. Only equi-joins.
    """
    listed = lambda df, as_: df.select(F.col(key).alias(as_), F.posexplode(F.filter(F.transform(F.split(F.coalesce(F.col(paths), F.lit("")), ";"), lambda v: F.trim(v)), lambda x: ~F.lower(x).isin("", "nan"))).alias("place", "p"))
    valid = main.filter(clean(F.col(key).cast("string")).isNotNull())
    by_path = listed(valid, "main").groupBy("p").agg(F.max("main").alias("main"))
    by_id = valid.select(F.col(key).alias("main"), uuid8(F.col(current)).alias("p")).filter("p IS NOT NULL").groupBy("p").agg(F.max("main").alias("main"))
    own = listed(duplicates, "dup")
    steps = [
        (own, by_path, 1),
        (duplicates.select(F.col(key).alias("dup"), F.lit(0).alias("place"), uuid8(F.col(current)).alias("p")), by_id, 2),
        (own.withColumn("p", uuid8(F.col("p"))), by_id, 3),
    ]
    found = [d.join(m, "p").select("dup", F.struct(F.lit(k).alias("step"), F.col("place").alias("place"), F.col("main").alias("main")).alias("m")) for d, m, k in steps]
    best = reduce(DataFrame.unionByName, found).groupBy("dup").agg(F.min("m").alias("m"))
    return duplicates.select(F.col(key).alias("dup")).join(best, "dup", "left").select(F.col("dup").alias(key), F.coalesce(F.col("m.main").cast("string"), F.lit("__unmatched__")).alias("main"), F.coalesce("m.step", F.lit(0)).alias("step"))


def orphans(files: DataFrame, key: str, of: str = "duplicate_of") -> DataFrame:
    """Files whose original is not among them."""
    return files.filter(F.col(of).isNotNull()).join(files.select(F.col(key).alias(of)).distinct(), of, "left_anti").select(key, of)


def clear_orphans(files: DataFrame, key: str, of: str = "duplicate_of") -> DataFrame:
    known = files.select(F.col(key).alias(of)).distinct().withColumn("_known", F.lit(True))
    return files.join(known, of, "left").withColumn(of, F.when(F.col("_known"), F.col(of))).drop("_known").select(*files.columns)


def with_all_paths(files: DataFrame, key: str, path: str, of: str = "duplicate_of") -> DataFrame:
    """Originals with their own path and those of their duplicates, '; '-joined in order of path."""
    copies = files.filter(F.col(of).isNotNull()).groupBy(F.col(of).alias(key)).agg(F.array_join(F.array_sort(F.collect_set(path)), "; ").alias("_more"))
    out = files.filter(F.col(of).isNull()).join(copies, key, "left")
    return out.select(key, merge_lists(F.col(path), F.col("_more")).alias("all_paths"))


def compare_sides(pairs: DataFrame, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, key) of rows that are only in one of two mappings, and of `left` rows that have a pair (a, b)."""
    a, b = pairs.select(F.col("a").alias(key)).distinct(), pairs.select(F.col("b").alias(key)).distinct()
    tag = lambda df, s: df.select(F.lit(s).alias("side"), key)
    return tag(left.join(a, key, "left_anti"), "left").unionByName(tag(right.join(b, key, "left_anti"), "right")).unionByName(tag(left.join(a, key, "left_semi"), "both"))


def first_of(wanted: DataFrame, key: str, candidates: list[DataFrame], found: str) -> DataFrame:
    """`found` of the first candidate table that has the key (of several rows the smallest), with its step from 1; null without one."""
    tagged = [c.select(key, F.struct(F.lit(k).alias("step"), F.col(found).alias("found")).alias("m")) for k, c in enumerate(candidates, 1)]
    best = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.min("m").alias("m"))
    return wanted.select(key).join(best, key, "left").select(key, F.col("m.found").alias(found), F.col("m.step").alias("step"))


def rows_of_paths(wanted: DataFrame, registry: DataFrame, path: str, key: str, columns: list[str]) -> DataFrame:
    """Registry key of each path: by equality with a path in `columns`, else by file name."""
    listed = reduce(DataFrame.unionByName, [registry.select(F.col(key), F.col(c).alias(path)) for c in columns]).filter(F.col(path).isNotNull())
    named = listed.select(key, base_name(F.col(path)).alias("_name"))
    by_name = wanted.select(path, base_name(F.col(path)).alias("_name")).join(named, "_name").select(path, key)
    return first_of(wanted, path, [listed, by_name], key)


def resolve_paths(stored: DataFrame, listing: DataFrame, path: str, root: str) -> DataFrame:
    """The file that a stored path stands for: itself, below `root`, with forward slashes, else the smallest of its name."""
    files = listing.select(F.col("path").alias("_file"))
    tries = [F.col(path), F.concat(F.lit(root.rstrip("/") + "/"), F.col(path)), F.concat(F.lit(root.rstrip("/") + "/"), F.replace(F.col(path), F.lit("\\"), F.lit("/")))]
    steps = [stored.select(path, t.alias("_file")).join(files, "_file") for t in tries]
    steps.append(stored.select(path, base_name(F.col(path)).alias("_name")).join(files.withColumn("_name", base_name(F.col("_file"))), "_name").select(path, "_file"))
    return first_of(stored, path, steps, "_file").withColumnRenamed("_file", "file")


def rewrite_paths(rows: DataFrame, column: str, staging: str, output: str, moved: DataFrame) -> DataFrame:
    """Paths after a merge: `moved` (path, new_path) first, else staging becomes output; then relative to output."""
    out = rows.join(moved.select(F.col("path").alias(column), "new_path"), column, "left")
    shifted = F.when(F.col(column).startswith(staging), F.concat(F.lit(output), F.substr(F.col(column), F.lit(len(staging) + 1)))).otherwise(F.col(column))
    return out.withColumn(column, relative(F.coalesce("new_path", shifted), output)).drop("new_path").select(*rows.columns)


def review_order(rows: DataFrame, hashes: DataFrame, key: str, paths: str, phash: str) -> DataFrame:
    """Rows with rn: by folder of the first path (without one last), then by hash; an empty hash comes first, a missing row last."""
    first = F.get(F.split(F.coalesce(clean(F.col(paths)), F.lit("")), ";"), F.lit(0))
    folder = F.coalesce(F.nullif(F.lower(parent(F.trim(first))), F.lit("")), F.lit("￿"))
    out = rows.join(hashes.select(key, F.coalesce(phash, F.lit("")).alias("_hash")), key, "left").withColumn("_folder", folder).withColumn("_hash", F.coalesce("_hash", F.lit("z" * 16)))
    return numbered(out, "_folder", "_hash", key).drop("_folder", "_hash")


def nested_sample(rows: DataFrame, hashes: DataFrame, links: DataFrame, key: str, limit: int) -> DataFrame:
    """The first rows by key with their hash row and the keys of their duplicates."""
    first = rows.orderBy(key).limit(limit)
    copies = links.groupBy(F.col("main").alias(key)).agg(F.array_sort(F.collect_list("dup")).alias("duplicates"))
    return first.join(hashes, key, "left").join(copies, key, "left")
