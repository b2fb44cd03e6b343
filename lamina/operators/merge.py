"""Merging a staged batch into a collection: links to originals, registries, and a plan for the files, out of one set of links.

A staged row points at the first row that it copies: of the collection, else of its own batch. Such links form chains;
what a copy knows goes to the root of its chain, in the order of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.scalar import base_name, clean, parent
from lamina.operators.fingerprint import near_hashes
from lamina.operators.match import unique_names
from lamina.operators.tree import nearest, roots
from lamina.sources.snapshots import written

#: Folder of copies; columns that a merge does not compare; the column of comments.
DUPLICATES = "Duplicados"
NOT_COMPARED = ["created_at", "updated_at", "timestamp", "uuid", "id", "current_path", "original_path"]
COMMENTS = "comentarios"
#: Ways in which a row matches, the first that holds counts.
HOW = ["perceptual", "near", "exact"]


@dataclass
class Merged:
    """Registries after a merge, the links behind them and what the registries did not agree on."""

    annotations: DataFrame
    hashes: DataFrame
    duplicates: DataFrame
    conflicts: DataFrame
    links: DataFrame


def _firsts(rows: DataFrame, column: str) -> DataFrame:
    """(column, first): the first row of each value that is not blank."""
    return rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min("row").alias("first"))


def _by_hash(hashes: DataFrame, others: DataFrame, most: int) -> DataFrame:
    """(phash, same, near) for each staged hash: the first row with the same hash, and the first of another hash that is at most `most` bits away.

    First means the order of rows, not distance. Hashes are compared, not rows, however many share one.
    """
    first = _firsts(others, "phash")
    close = near_hashes(hashes, others, most, "phash").select(F.col("ha").alias("phash"), F.col("hb").alias("_b"))
    near = close.join(first.select(F.col("phash").alias("_b"), "first"), "_b").groupBy("phash").agg(F.min("first").alias("near"))
    return hashes.select("phash").join(first.withColumnRenamed("first", "same"), "phash", "left").join(near, "phash", "left")


def links(staged: DataFrame, kept: DataFrame, annotated: DataFrame, most: int = 8, key: str = "uuid", phash: str = "phash", digest: str = "md5_hash", order: str = "ordinal") -> DataFrame:
    """(key, of, how, inside, root, steps) of staged rows that copy another.

    staged, kept: (key, hash, digest, order). A row's match in the collection is the first row of the same hash, else of a near hash,
    else of the same digest; it counts if `annotated` has that row, and there is no second choice. Without one the same is asked of the rows that
    come before it in the batch, copies or not. inside: the link stays in the batch. root: the end of the chain. Blank keys, hashes and digests match nothing.
    """
    tidy = lambda df: df.select(clean(F.col(key).cast("string")).alias("key"), clean(F.col(phash)).alias("phash"), clean(F.col(digest)).alias("digest"), F.col(order).alias("order")).filter("key IS NOT NULL").withColumn("row", F.struct("order", "key"))
    s, k = written(tidy(staged)), written(tidy(kept))
    hashes = written(s.filter("phash IS NOT NULL").select("phash").distinct())
    outside = _by_hash(hashes, k, most).select("phash", *[F.col(c).alias(f"_{c}") for c in ("same", "near")])
    inside = _by_hash(hashes, s, most)
    digests = s.filter("digest IS NOT NULL").select("digest").distinct()
    digests = digests.join(_firsts(k, "digest").withColumnRenamed("first", "_exact"), "digest", "left").join(_firsts(s, "digest").withColumnRenamed("first", "exact"), "digest", "left")
    row = s.join(outside.join(inside, "phash"), "phash", "left").join(digests, "digest", "left")
    pick = lambda cols: F.coalesce(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(HOW[i]).alias("how"), F.col(f"{c}.key").alias("of"))) for i, c in enumerate(cols)])
    before = {c: F.when(F.col(f"{c}.order") < F.col("order"), F.col(c)) for c in ("same", "near", "exact")}
    row = row.select("key", pick(["_same", "_near", "_exact"]).alias("out"), *[v.alias(c) for c, v in before.items()]).select("key", "out", pick(list(before)).alias("in"))
    known = annotated.select(clean(F.col(key).cast("string")).alias("_of")).filter("_of IS NOT NULL").distinct().withColumn("_known", F.lit(True))
    row = row.join(known, F.col("out.of") == F.col("_of"), "left")
    taken = F.when(F.col("_known"), F.struct("out.how", "out.of", F.lit(False).alias("inside"))).otherwise(F.when(F.col("in").isNotNull(), F.struct("in.how", "in.of", F.lit(True).alias("inside"))))
    out = written(row.select("key", taken.alias("l")).filter("l IS NOT NULL").select("key", "l.of", "l.how", "l.inside"))
    return out.join(roots(out, "key", "of"), "key").withColumnRenamed("key", key)


def merge(staged: DataFrame, kept: DataFrame, found: DataFrame, staged_hashes: DataFrame, kept_hashes: DataFrame, decisions: DataFrame | None = None, default: str = "existing", key: str = "uuid", paths: str = "original_path", order: str = "ordinal") -> Merged:
    """Registries after a merge by the links that `links` has found.

    A root takes from its copies, in their order: all paths, each once, behind its own; the first value of a field that it lacks; the longest
    comment, its own on ties. A copy's other value is a conflict. `default` says whose value stays: `existing`, `staged` (of several the last),
    or `defer` (the existing one, marked for review). decisions: (folder, choice) for what came from below a folder, the nearest one counts;
    a row comes from the folder of its first path. Staged rows without a hash row are left out, as are repeated keys but the first.
    """
    fields = [c for c in staged.columns if c in kept.columns and c not in [*NOT_COMPARED, key, paths, order]]
    rank = F.col(order)
    first_of = lambda df: df.filter(clean(F.col(key).cast("string")).isNotNull()).groupBy(F.col(key).cast("string").alias(key)).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns if c != key]), rank).alias("r")).select(key, "r.*")
    batch = written(first_of(staged).join(staged_hashes.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_semi"))
    tied = batch.join(found, key, "left")
    copies = tied.filter("root IS NOT NULL")
    new = tied.filter("root IS NULL").select(*batch.columns)

    # the folder of a copy's first path says whose values stay
    first_path = F.trim(F.get(F.split(F.coalesce(clean(F.col(paths)), F.lit("")), ";"), F.lit(0)))
    copies = copies.withColumn("_folder", F.nullif(parent(first_path), F.lit("")))
    if decisions is not None:
        copies = nearest(copies, "_folder", decisions.select("folder", "choice"), "folder").drop("_nearest", "_depth")
    else:
        copies = copies.withColumn("choice", F.lit(None).cast("string"))
    copies = written(copies.withColumn("choice", F.coalesce("choice", F.lit(default))))

    said = lambda f: clean(F.col(f).cast("string"))
    place = F.struct(F.col(order), F.col(key))
    gathered = copies.groupBy(F.col("root").alias(key)).agg(
        *[F.min_by(said(f), F.when(said(f).isNotNull(), place)).alias(f"first_{f}") for f in fields if f != COMMENTS],
        *[F.max_by(said(f), F.when(said(f).isNotNull() & (F.col("choice") == "staged"), place)).alias(f"last_{f}") for f in fields if f != COMMENTS],
        *[F.min_by(said(f), F.when(said(f).isNotNull(), F.struct(-F.length(said(f)), F.col(order), F.col(key)))).alias(f"first_{f}") for f in fields if f == COMMENTS],
    )
    # each path once for each root before its paths meet in one text
    parts = copies.select(F.col("root").alias(key), order, F.posexplode(F.split(F.coalesce(clean(F.col(paths)), F.lit("")), ";")).alias("at", "p")).withColumn("p", clean(F.col("p"))).filter("p IS NOT NULL")
    once = parts.groupBy(key, "p").agg(F.min(F.struct(order, "at")).alias("at"))
    listed = once.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "p"))), lambda x: x["p"]).alias("_paths"))

    tell = lambda df, name: df.withColumn("_from", F.lit(name))
    base = tell(first_of(kept) if order in kept.columns else kept.withColumn(key, F.col(key).cast("string")), "existing").unionByName(tell(new, "new"), allowMissingColumns=True)
    whole = base.join(gathered, key, "left").join(listed, key, "left")

    def value(f: str) -> Column:
        own, first = said(f), F.col(f"first_{f}")
        if f == COMMENTS:
            return F.when(own.isNull() | (F.length(first) > F.length(own)), F.coalesce(first, own)).otherwise(own)
        return F.coalesce(F.col(f"last_{f}"), own, first)

    own_paths = F.filter(F.transform(F.split(F.coalesce(clean(F.col(paths)), F.lit("")), ";"), lambda p: clean(p)), lambda p: p.isNotNull())
    all_paths = F.nullif(F.array_join(F.array_distinct(F.concat(own_paths, F.coalesce("_paths", F.array().cast("array<string>")))), "; "), F.lit(""))
    out = whole.select(*[(all_paths if c == paths else value(c) if c in fields else F.col(c)).alias(c) for c in base.columns if c != "_from"], F.col("_from").alias("origin"))

    # what a copy says and its root does not, from whichever the value has come
    roots_say = base.select(F.col(key).alias("root"), *[said(f).alias(f"_o_{f}") for f in fields]).join(gathered.withColumnRenamed(key, "root"), "root")
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f"_o_{f}"), F.col(f"first_{f}")).alias("existing"), said(f).alias("staged")) for f in fields if f != COMMENTS])
    conflicts = copies.join(roots_say, "root").select(key, "root", "choice", F.explode(F.filter(cells, lambda c: c["staged"] != c["existing"])).alias("c")).select(key, "root", "c.*", "choice") if any(f != COMMENTS for f in fields) else None
    hashes = kept_hashes.withColumn(key, F.col(key).cast("string")).join(copies.select(key), key, "left_anti").unionByName(staged_hashes.withColumn(key, F.col(key).cast("string")).join(new.select(key), key, "left_semi"), allowMissingColumns=True)
    return Merged(out, hashes, copies.select(*batch.columns, F.col("of").alias("duplicate_of"), "root", "how"), conflicts, found)


def file_plan(files: DataFrame, taken: DataFrame, found: DataFrame, key: str = "uuid", rel: str = "rel", decisions: DataFrame | None = None, default: str = "keep") -> DataFrame:
    """(key, rel, action, target): what happens to each staged file.

    A copy of another goes to the folder of copies under a name that is free there. Another file is copied to its own place, if that is
    free; where it is not, the choice holds: keep (the existing file, nothing is copied), overwrite, or both (it is copied as <stem>_merged_<k>,
    k being the first number that is free). taken: (rel) of the collection's files. decisions: (folder, choice), the nearest one above the file counts.
    """
    copies = found.select(F.col(key).cast("string").alias(key), F.lit(True).alias("_copy"))
    there = taken.select(F.col(rel)).distinct()
    rows = files.select(F.col(key).cast("string").alias(key), rel).join(copies, key, "left").join(there.withColumn("_there", F.lit(True)), rel, "left")
    rows = rows.withColumns({"_folder": F.when(F.col(rel).contains("/"), parent(F.col(rel))).otherwise(F.lit("")), "_name": base_name(F.col(rel))})
    if decisions is not None:
        rows = nearest(rows, "_folder", decisions.select("folder", "choice"), "folder").drop("_nearest", "_depth")
    else:
        rows = rows.withColumn("choice", F.lit(None).cast("string"))
    choice = F.coalesce("choice", F.lit(default))
    action = F.when(F.col("_copy"), "duplicate").when(F.col("_there").isNull(), "copy").when(choice == "overwrite", "overwrite").when(choice == "both", "merged").otherwise("keep")
    rows = written(rows.select(key, rel, "_folder", "_name", action.alias("action")))
    at = lambda df: df.select(F.when(F.col(rel).contains("/"), parent(F.col(rel))).otherwise(F.lit("")).alias("_folder"), base_name(F.col(rel)).alias("_name"))
    in_use = at(there).unionByName(at(rows.filter("action = 'copy'")))
    merged = unique_names(rows.filter("action = 'merged'").select(key, "_folder", "_name"), "_name", key, "_folder", in_use, "_merged_")
    copied = unique_names(rows.filter("action = 'duplicate'").select(key, "_name"), "_name", key, taken=at(there).filter(F.col("_folder") == DUPLICATES).select("_name"))
    names = merged.select(key, F.concat(F.when(F.col("_folder") == "", "").otherwise(F.concat("_folder", F.lit("/"))), F.col("unique_name")).alias("_to"))
    names = names.unionByName(copied.select(key, F.concat(F.lit(f"{DUPLICATES}/"), F.col("unique_name")).alias("_to")))
    return rows.join(names, key, "left").select(key, rel, "action", F.when(F.col("action").isin("copy", "overwrite"), F.col(rel)).otherwise(F.col("_to")).alias("target"))


def without_hashes(files: DataFrame, hashes: DataFrame, key: str = "uuid", rel: str = "rel", kind: str = "type") -> DataFrame:
    """Staged images that no hash row knows by key or by path; copies in their folder need none."""
    image = files.filter((F.col(kind) == "image") & (F.lower(F.get(F.split(F.col(rel), "/"), F.lit(0))) != DUPLICATES.lower()))
    told = hashes.filter(clean(F.col("md5_hash")).isNotNull())
    by_key = told.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    by_path = told.select(F.col("file_path").alias(rel)).filter(F.col(rel).isNotNull()).distinct()
    return image.withColumn(key, F.col(key).cast("string")).join(by_key, key, "left_anti").join(by_path, rel, "left_anti").select(*files.columns)


def summary(merged: Merged) -> DataFrame:
    """(part, n): rows of each registry after a merge, copies by how they were found, conflicts by field."""
    rows = [merged.annotations.groupBy(F.concat(F.lit("annotations_"), F.col("origin")).alias("part")).agg(F.count("*").alias("n"))]
    rows.append(merged.hashes.agg(F.count("*").alias("n")).select(F.lit("hashes").alias("part"), "n"))
    rows.append(merged.duplicates.groupBy(F.concat(F.lit("duplicates_"), F.col("how")).alias("part")).agg(F.count("*").alias("n")))
    if merged.conflicts is not None:
        rows.append(merged.conflicts.groupBy(F.concat(F.lit("conflicts_"), F.col("field")).alias("part")).agg(F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, rows)
