"""The whole run over folders of files, stage by stage, with snapshots by which a run that was stopped goes on.

listed -> hashed -> extracted -> marked -> routed; then registries and a plan of copies in a staging folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import patterns
from lamina.operators import dedup, review, routing
from lamina.sources import files, images
from lamina.sources.reports import Log
from lamina.sources.snapshots import Run, Snapshots, Stage, Store

INFO = "staging_info.json"
#: What is counted of each stage.
FOUND = {
    "hashed": lambda: {"pictures": F.col("phash").isNotNull(), "unread": F.col("digest").isNull()},
    "extracted": lambda: {"specimens": F.col("specimen_id").isNotNull(), "to_review": F.col("needs_review")},
    "marked": lambda: {"exact": F.col("duplicate_type") == "exact", "perceptual": F.col("duplicate_type") == "perceptual"},
    "routed": lambda: {"duplicates": F.col("folder") == "Duplicados", "lost": F.col("folder") == "Casos_Perdidos_Generales"},
}


def hashed(spark: SparkSession, folders: Sequence[str], listing: DataFrame) -> DataFrame:
    """Listed files with digest, and pictures with phash; files that cannot be read have none. Only files with a picture's suffix are decoded."""
    every = reduce(DataFrame.unionByName, [files.contents(spark, f) for f in folders])
    seen = reduce(DataFrame.unionByName, [images.image_hashes(spark, f, files.SUFFIX_GLOB) for f in folders])
    # sources write file:/a b and file:///a%20b for the same file
    seen = seen.withColumn("path", F.expr("coalesce(try_url_decode(replace(path, '+', '%2B')), path)"))
    at = lambda df: F.regexp_replace(df["path"], "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/").alias("_at")
    out = listing.join(every.withColumnRenamed("md5_hash", "digest").dropDuplicates(["path"]), "path", "left")
    out = out.select("*", at(out)).join(seen.select(at(seen), "phash").groupBy("_at").agg(F.min("phash").alias("phash")), "_at", "left")
    return out.drop("_at")


def _taxon(level: str) -> Column:
    return F.get(F.filter("info.taxa", lambda t: t["level"] == level), F.lit(0))["value"]


def extracted(rows: DataFrame) -> DataFrame:
    """Files with what their paths say, as columns."""
    out = rows.withColumn("info", patterns.extraction(F.col("path"))).withColumn("file_type", F.col("type"))
    named = {"macroclass": _taxon("phylum"), "taxonomic_class": _taxon("class"), "determination": F.coalesce(_taxon("family"), _taxon("order"))}
    out = out.withColumns(named | {"specimen_id": F.col("info.specimen.specimen_id"), "campaign_year": F.col("info.campaign_year"), "collection": F.col("info.collection")})
    return out.withColumn("needs_review", review.needs_review(F.col("type"), F.col("specimen_id"), F.col("collection"))).drop("info")


def marked(rows: DataFrame) -> DataFrame:
    """Files with is_duplicate, duplicate_of, duplicate_type and root."""
    links = dedup.mark_duplicates(rows.select("path", "digest", "phash"), "digest", "phash", "path")
    return rows.join(links, "path", "left").withColumn("is_duplicate", F.col("duplicate_of").isNotNull())


def routed(rows: DataFrame, review_unknown: bool) -> DataFrame:
    """Files with folder and new name. review_unknown: pictures that need a review go to a folder for it."""
    reason = F.when(F.col("specimen_id").isNull(), "No_Specimen_ID").otherwise("Unknown_Collection")
    asks = F.col("needs_review") if review_unknown else F.lit(False)
    out = routing.route(rows.withColumns({"needs_review": asks, "review_reason": F.when(asks, reason)}))
    return out.withColumn("target", F.concat_ws("/", F.nullif(F.col("folder"), F.lit("")), "new_name"))


def organize(spark: SparkSession, folders: Sequence[str], state: str, review_unknown: bool = False, log: Log | None = None) -> Run:
    """Runs all stages over the folders; those whose input has not changed since a run with the same `state` are taken from there.

    The key of the input is of the listing: paths, sizes and times. Folders that are not there count as empty.
    log: gets the rows of each stage that runs and what it found, counted by the job that writes them.
    """
    there = [f for f in folders if Store(spark, f).exists()]
    listing = files.scan(spark, *there)
    if not there:
        listing = listing.limit(0)
    version = f"1 {sorted(there)}"
    steps = [
        Stage("hashed", lambda df: hashed(spark, there, df) if there else df.withColumns({"digest": F.lit(None).cast("string"), "phash": F.lit(None).cast("string")}), version),
        Stage("extracted", extracted), Stage("marked", marked), Stage("routed", lambda df: routed(df.withColumnRenamed("folder", "source_folder"), review_unknown), f"1 {review_unknown}"),
    ]
    if log is not None:
        steps = [Stage(s.name, lambda df, s=s: log.watch(s.name, s.run(df), **FOUND[s.name]()), s.version) for s in steps]
    return Snapshots(spark, state).run(listing, steps)


def stage(spark: SparkSession, result: DataFrame, staging: str, output: str, dry_run: bool = False) -> dict[str, int]:
    """Registries and the copy plan of a run, below `staging`; rows of each. dry_run: counts only."""
    parts = files.split_registries(result.withColumn("type", F.col("file_type"))) | {"plan": result.select("path", "target", "is_duplicate")}
    counts = {}
    for name, df in parts.items():
        counts[name] = df.count()
        if not dry_run:
            files.save_registry(df, f"{staging.rstrip('/')}/registries/{name}")
    if not dry_run:
        Store(spark, staging).write(json.dumps({"final_output_dir": output, "counts": counts}), INFO)
    return counts


def staging_info(spark: SparkSession, staging: str) -> dict | None:
    """What a staging folder says of itself; null without its file."""
    store = Store(spark, staging)
    return json.loads(store.read(INFO)) if store.exists(INFO) else None
