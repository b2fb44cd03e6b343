"""Incremental deduplication of arriving files against a registry of digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def dedup_batch(batch: DataFrame, registry: DataFrame, digest: str, key: str) -> DataFrame:
    """Rows of a batch whose digest the registry has not and that come first in the batch; rows without a digest stay."""
    first = batch.groupBy(digest).agg(F.min(key).alias(key))
    known = batch.filter(F.col(digest).isNotNull()).join(first, [digest, key], "left_semi").join(registry.select(digest), digest, "left_anti")
    return known.select(*batch.columns).unionByName(batch.filter(F.col(digest).isNull()))


def start(stream: DataFrame, registry_path: str, checkpoint: str, digest: str, key: str) -> StreamingQuery:
    """Appends new rows to the registry, each micro-batch under its own folder, so that one that runs again writes the same."""
    spark = stream.sparkSession
    schema = stream.schema

    def step(batch: DataFrame, number: int) -> None:
        known = spark.read.schema(schema.add("batch", "long")).option("basePath", registry_path).parquet(registry_path) if number else None
        seen = known.filter(F.col("batch") < number) if known is not None else batch.limit(0)
        dedup_batch(batch, seen, digest, key).write.mode("overwrite").parquet(f"{registry_path}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()


def windowed_counts(stream: DataFrame, time: str, group: str, width: str, late: str) -> DataFrame:
    """Counts in tumbling windows; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), group).agg(F.count("*").alias("n"))
