"""What has been published: summaries and listings of objects.

Listings stay rows. A nested document would gather all objects of one dataset in
one cell, and a single dataset may own most of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.keys import partition_type_of
from partflow.functions.text import gibibytes

# Objects at the root that describe the others.
OWN_FILES = ("manifest.json", "index.html")


def manifest_entries(objects: DataFrame) -> DataFrame:
    """Objects (``key``, ``size``, ``last_modified``) with exactly three key parts and a known partition shape."""
    parts = F.split("key", "/")
    value = parts.getItem(1)
    return (
        objects.where(~F.col("key").isin(*OWN_FILES) & (F.size(parts) == 3))
        .select(
            parts.getItem(0).alias("exporter"),
            value.alias("partition_value"),
            partition_type_of(value).alias("partition_type"),
            F.col("key").alias("s3_key"),
            parts.getItem(2).alias("file_name"),
            F.col("size").alias("file_size_bytes"),
            "last_modified",
        )
        .where(F.col("partition_type").isNotNull())
    )


def manifest_summary(entries: DataFrame) -> DataFrame:
    """Per exporter: files, bytes, first and last partition; values compare as texts.

    The partition type is that of the first key.
    """
    return entries.groupBy("exporter").agg(
        F.min_by("partition_type", "s3_key").alias("partition_type"),
        F.count(F.lit(1)).alias("total_files"),
        F.sum("file_size_bytes").alias("total_size_bytes"),
        F.min("partition_value").alias("earliest_partition"),
        F.max("partition_value").alias("latest_partition"),
    )


def manifest_totals(summary: DataFrame) -> DataFrame:
    """One row over all exporters."""
    totals = summary.agg(
        F.coalesce(F.sum("total_files"), F.lit(0)).alias("total_files"),
        F.coalesce(F.sum("total_size_bytes"), F.lit(0)).alias("total_size_bytes"),
        F.count(F.lit(1)).alias("exporters"),
    )
    return totals.withColumn("total_size_gb", gibibytes(F.col("total_size_bytes")))


def file_index(objects: DataFrame) -> DataFrame:
    """Parquet objects with their exporter, the first part of the key, at any depth."""
    return objects.where(F.col("key").endswith(".parquet")).select(
        F.split_part("key", F.lit("/"), F.lit(1)).alias("exporter"), F.col("key").alias("file")
    )


def file_counts(index: DataFrame) -> DataFrame:
    """Number of indexed files per exporter."""
    return index.groupBy("exporter").agg(F.count(F.lit(1)).alias("file_count"))
