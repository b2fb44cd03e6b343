"""Sources and sinks: folder scans, registries, copy plans, reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.patterns import relative
from lamina.functions.scalar import SUFFIXES, base_name, file_type, parent, segments
from lamina.operators.match import unique_names
from lamina.sources.snapshots import Store, recover, swap, written

#: File names of pictures, as a glob.
SUFFIX_GLOB = "*.{" + ",".join(x for s in SUFFIXES["image"] for x in (s, s.upper())) + "}"
_text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
#: Columns of the registries.
ANNOTATIONS = T.StructType(_text("uuid", "specimen_id", "original_path", "current_path", "macroclass_label", "class_label", "genera_label", "campaign_year", "fuente", "comentarios", "created_at"))
HASHES = T.StructType(_text("uuid", "md5_hash", "phash", "file_path", "created_at"))
TEXT_FILES = T.StructType([*_text("id", "original_path", "current_path", "original_filename", "file_type"), T.StructField("processed", T.BooleanType()), *_text("extracted_info", "created_at")])
OTHER_FILES = T.StructType(_text("id", "original_path", "current_path", "original_filename", "file_type", "created_at"))


def scan(spark: SparkSession, *folders: str, hidden: bool = False) -> DataFrame:
    """Files below the folders: path, size, modified, name, type. Contents are not read. Missing folders count as empty."""
    out = None
    for folder in folders:
        try:
            df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        except AnalysisException:
            continue
        part = df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "path string, size long, modified timestamp")
    if not hidden:
        out = out.filter(~F.exists(segments(F.col("path")), lambda x: x.startswith(".")))
    return out.withColumns({"name": base_name(F.col("path")), "folder": parent(F.col("path")), "type": file_type(F.col("path"))})


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """md5 of each file's bytes."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return df.select("path", F.md5("content").alias("md5_hash"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images: path, width, height and an md5 of the pixels; null where a file cannot be decoded."""
    i = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(folder).select("image.*")
    ok = F.col("height") > 0
    pixels = F.md5(F.concat(F.col("width").cast("string").cast("binary"), F.lit("x").cast("binary"), F.col("height").cast("string").cast("binary"), F.col("data")))
    return i.select(F.col("origin").alias("path"), F.when(ok, F.col("width")).alias("width"), F.when(ok, F.col("height")).alias("height"), F.when(ok, pixels).alias("md5_pixels"))


def registry(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A registry table; an absent one is empty. A swap that a crash has cut short is ended first."""
    recover(spark, path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def save_registry(df: DataFrame, path: str, csv: bool = False) -> None:
    """Writes beside `path` and then takes its place, so a plan that reads `path` may be saved to it and a crash leaves the old or the new one."""
    swap(df, path, lambda rows, to: rows.write.option("header", True).csv(to) if csv else rows.write.parquet(to))


def split_registries(files: DataFrame) -> dict[str, DataFrame]:
    """Images, duplicates, texts and others of processed files."""
    image, copy = F.coalesce(F.col("type") == "image", F.lit(False)), F.coalesce(F.col("is_duplicate"), F.lit(False))
    text = F.coalesce(F.col("type") == "text", F.lit(False))
    return {"annotations": files.filter(image & ~copy), "duplicates": files.filter(image & copy), "text_files": files.filter(text), "other_files": files.filter(~image & ~text)}


def count_files(spark: SparkSession, *folders: str, hidden: bool = True) -> DataFrame:
    """(type, n) of the files below the folders, hidden ones included."""
    return scan(spark, *folders, hidden=hidden).groupBy("type").agg(F.count("*").alias("n"))


def top_folders(files: DataFrame, root: str, kind: str | None = "image") -> DataFrame:
    """First folders below `root`, with their files of that type (all: None)."""
    rel = segments(relative(F.col("path"), root))
    out = files.filter(F.col("path").startswith(root.rstrip("/") + "/") & (F.size(rel) > 1))
    if kind is not None:
        out = out.filter(F.col("type") == kind)
    return out.groupBy(F.get(rel, F.lit(0)).alias("folder")).agg(F.count("*").alias("n"))


def copy_plan(staged: DataFrame, kept: DataFrame, overwrite: bool = False) -> DataFrame:
    """(rel, digest, action, new_rel) of staged files (rel, digest): skip equal content, resolve a taken name, else copy.

    A name is taken by a kept file or by a staged one of another content, the least digest having the first right; the others
    become <stem>_merged_<k><suffix>, k being the first number whose name is free. Repeated rows count once; a null digest equals none.
    """
    rows = staged.select("rel", "digest").distinct()
    same = kept.filter("digest IS NOT NULL").select("digest").distinct().withColumn("known", F.lit(True))
    taken = kept.select("rel").distinct().withColumn("taken", F.lit(True))
    first = rows.join(same, "digest", "left_anti").groupBy("rel").agg(F.min(F.struct(F.col("digest").isNull().alias("n"), "digest")).alias("first"))
    out = rows.join(same, "digest", "left").join(taken, "rel", "left").join(first, "rel", "left")
    mine = F.struct(F.col("digest").isNull().alias("n"), "digest").eqNullSafe(F.col("first"))
    action = F.when(F.col("known"), "duplicate").when(F.col("taken"), "overwrite" if overwrite else "rename").when(mine, "copy").otherwise("rename")
    out = written(out.select("rel", "digest", action.alias("action")))
    at = lambda df: df.select(F.when(F.col("rel").contains("/"), parent(F.col("rel"))).otherwise("").alias("folder"), base_name(F.col("rel")).alias("name"))
    renamed = out.filter("action = 'rename'").select(F.struct("rel", "digest").alias("key"), "rel")
    names = unique_names(renamed.select("key", F.when(F.col("rel").contains("/"), parent(F.col("rel"))).otherwise("").alias("folder"), base_name(F.col("rel")).alias("name")), "name", "key", "folder", at(kept.select("rel").unionByName(out.filter("action = 'copy'").select("rel"))), "_merged_")
    named = names.select("key.rel", "key.digest", F.concat(F.when(F.col("folder") == "", "").otherwise(F.concat("folder", F.lit("/"))), F.col("unique_name")).alias("new_rel"))
    o, n = out.alias("o"), named.alias("n")
    return o.join(n, (F.col("o.rel") == F.col("n.rel")) & F.col("o.digest").eqNullSafe(F.col("n.digest")) & (F.col("o.action") == "rename"), "left").select("o.*", "n.new_rel")


def pictures(rows: DataFrame) -> DataFrame:
    """Files that are pictures by their suffix, in the order of their paths whatever the case."""
    return rows.filter(F.col("type") == "image").orderBy(F.lower("path"), "path")


def registry_folder(spark: SparkSession, output: str) -> str | None:
    """Where a collection keeps its registries: `registries`, else `registros`; null without either."""
    store = Store(spark, output)
    return next((store.join(n) for n in ("registries", "registros") if store.exists(n)), None)
