"""Listings and summaries over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.text import gibibytes

# all errors of a run share its time; without more to sort by they would all
# fall into one range, hence one task
_TIES = ("exporter", "partition_value")


def uploads_per_exporter(uploads: DataFrame) -> DataFrame:
    """Number and size of the uploads of every exporter."""
    return (
        uploads.groupBy("exporter")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("file_size").alias("total_bytes"))
        .withColumn("total_gb", gibibytes(F.col("total_bytes")))
    )


def upload_progress(uploads: DataFrame) -> DataFrame:
    """First, last and number of uploaded partitions; values compare as texts."""
    value = F.col("partition_value")
    return uploads.groupBy("exporter").agg(
        F.min(value).alias("earliest"), F.max(value).alias("latest"), F.count(value).alias("uploaded")
    )


def failures_per_exporter(errors: DataFrame) -> DataFrame:
    """Number of failures of every exporter."""
    return errors.groupBy("exporter").agg(F.count(F.lit(1)).alias("failures"))


def uploads_of(uploads: DataFrame, exporter: str) -> DataFrame:
    """Uploads of one exporter by partition."""
    return (
        uploads.where(F.col("exporter") == exporter)
        .select("partition_value", "uploaded_at", "file_size")
        .orderBy("partition_value", "uploaded_at")
    )


def failure_listing(errors: DataFrame) -> DataFrame:
    """Upload failures, newest first."""
    return errors.select("exporter", "partition_value", "error_details", "attempts", "created_at").orderBy(
        F.desc("created_at"), *_TIES
    )


def validation_differences(errors: DataFrame) -> DataFrame:
    """Validation failures with the difference of the counts, newest first."""
    return (
        errors.withColumn("diff", F.col("pq_count") - F.col("pg_count"))
        .select("exporter", "partition_value", "pq_count", "pg_count", "diff", "error_details", "created_at")
        .orderBy(F.desc("created_at"), *_TIES)
    )
