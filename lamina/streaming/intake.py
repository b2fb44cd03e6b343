"""Files that arrive in a folder, as a stream: each is scanned, read for what its path says, and matched against all that came before.

What came before is an index of values (digests, hashes) with the first file that had each. It is kept in buckets by hash of the value, and a
micro-batch reads the buckets alone that its own values fall into. Each batch writes under its own number, so one that runs again after a crash writes the
same; `compact` merges the parts of many batches.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.functions import patterns
from lamina.functions.scalar import base_name, file_type, parent, segments
from lamina.sources.snapshots import Store, swap

SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Buckets of an index, and what identifies a file, the first that is known counts.
BUCKETS = 256
INDEX = "kind int, value string, first struct<batch: long, key: string>"


def arrivals(spark: SparkSession, folder: str, most_files: int = 10_000, depth: int = 1, hidden: bool = False) -> DataFrame:
    """A stream of (path, size, modified, name, folder, type, digest) of files below `folder`, `depth` folders deep, as they arrive."""
    source = spark.readStream.format("binaryFile").schema(SCHEMA).option("maxFilesPerTrigger", most_files)
    df = source.load(posixpath.join(folder, *["*"] * (depth - 1)) if depth > 1 else folder)
    out = df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.md5("content").alias("digest"))
    if not hidden:
        out = out.filter(~F.exists(segments(F.col("path")), lambda x: x.startswith(".")))
    return out.withColumns({"name": base_name(F.col("path")), "folder": parent(F.col("path")), "type": file_type(F.col("path"))})


def described(files: DataFrame, path: str = "path") -> DataFrame:
    """Files with what their paths say: specimen, dates, taxa, campaign."""
    return files.withColumn("info", patterns.extraction(F.col(path)))


def _bucket(kind: Column, value: Column) -> Column:
    return F.pmod(F.xxhash64(kind, value), F.lit(BUCKETS)).cast("int")


def known(spark: SparkSession, index: str, before: int, buckets: list[int]) -> DataFrame:
    """Index rows of those buckets from batches before one; other buckets' files are not opened."""
    try:
        df = spark.read.schema(INDEX + ", batch long, bucket int").option("basePath", index).parquet(index)
    except AnalysisException:
        return spark.createDataFrame([], INDEX)
    return df.filter(F.col("bucket").isin(buckets) & (F.col("batch") < before)).select("kind", "value", "first")


def match_batch(batch: DataFrame, number: int, index: str, key: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """The batch with duplicate_of and how (name of the value, the first of `values` that is known), and its new index rows.

    The first file of a value is one of an earlier batch, else the least key of this one. Rows that have no value match nothing.
    """
    spark = batch.sparkSession
    cells = batch.select(key, F.posexplode(F.array(*[F.col(v).cast("string") for v in values])).alias("kind", "value")).filter("value IS NOT NULL AND trim(value) <> ''")
    cells = cells.withColumn("bucket", _bucket(F.col("kind"), F.col("value")))
    touched = [r[0] for r in cells.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    seen = known(spark, index, number, touched).groupBy("kind", "value").agg(F.min("first").alias("seen"))
    own = cells.groupBy("kind", "value", "bucket").agg(F.min(F.struct(F.lit(number).cast("long").alias("batch"), F.col(key).cast("string").alias("key"))).alias("own"))
    firsts = own.join(seen, ["kind", "value"], "left").withColumn("first", F.coalesce("seen", "own"))
    found = cells.join(firsts.select("kind", "value", "first"), ["kind", "value"]).filter(F.col("first.key") != F.col(key))
    best = found.groupBy(key).agg(F.min(F.struct("kind", "first")).alias("m"))
    how = F.element_at(F.array(*[F.lit(v) for v in values]), F.col("m.kind") + 1)
    out = batch.join(best, key, "left").select(*[batch[c] for c in batch.columns], F.col("m.first.key").alias("duplicate_of"), F.when(F.col("m").isNotNull(), how).alias("how"))
    return out, firsts.filter("seen IS NULL").select("kind", "value", "first", "bucket")


def run(stream: DataFrame, registry: str, checkpoint: str, key: str = "path", values: tuple[str, ...] = ("digest",), prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Takes in all that has arrived and ends; started again, it goes on behind it. Rows go to <registry>/files, the index to <registry>/index.

    prepare: what is done to each batch before it is matched (extraction from paths, hashes of pictures).
    """
    spark, files, index = stream.sparkSession, posixpath.join(registry, "files"), posixpath.join(registry, "index")

    def step(batch: DataFrame, number: int) -> None:
        rows = (prepare(batch) if prepare else batch).dropDuplicates([key]).persist()
        try:
            out, new = match_batch(rows, number, index, key, list(values))
            new.write.mode("overwrite").partitionBy("bucket").parquet(posixpath.join(index, f"batch={number}"))
            out.write.mode("overwrite").parquet(posixpath.join(files, f"batch={number}"))
        finally:
            rows.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()


def taken_in(spark: SparkSession, registry: str) -> DataFrame:
    """All files taken in so far, with the number of their batch."""
    at = posixpath.join(registry, "files")
    return spark.read.option("basePath", at).option("mergeSchema", True).parquet(at)


def compact(spark: SparkSession, registry: str) -> None:
    """Merges the index parts of all batches into those of the last one; no batch may run meanwhile."""
    index = posixpath.join(registry, "index")
    last = max((int(n.removeprefix("batch=")) for n in Store(spark, index).list() if n.startswith("batch=")), default=None)
    if last is None:
        return
    every = spark.read.schema(INDEX + ", batch long, bucket int").option("basePath", index).parquet(index)
    whole = every.groupBy("kind", "value", "bucket").agg(F.min("first").alias("first")).withColumn("batch", F.lit(last)).repartition("bucket")
    swap(whole, index, lambda df, to: df.write.partitionBy("batch", "bucket").parquet(to))
