"""Algebra of the ledger: what was published, what failed, what ran.

The ledger is append-only; these functions derive the current views. ``event_seq``
orders the events of one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.keys import parse_key
from partflow.functions.text import whole_number
from partflow.operators.keyed import newest_per_key
from partflow.operators.lookup import join_lookup
from partflow.operators.selection import COMPLETED, PARTITION_KEY

_KEY = list(PARTITION_KEY)


def current_uploads(events: DataFrame) -> DataFrame:
    """The latest upload record of every partition."""
    return newest_per_key(events, _KEY, ["event_seq"])


def current_errors(errors: DataFrame, cleared: DataFrame) -> DataFrame:
    """Errors that no later clearing of their partition took away."""
    last = cleared.groupBy(*_KEY).agg(F.max("event_seq").alias("_cleared_at"))
    survives = F.col("_cleared_at").isNull() | (F.col("event_seq") > F.col("_cleared_at"))
    return join_lookup(errors, last, _KEY).where(survives).drop("_cleared_at").select(*errors.columns)


def failed_partitions(upload_errors: DataFrame, validation_errors: DataFrame, uploads: DataFrame) -> DataFrame:
    """Distinct partitions with an error of either kind and no completed upload."""
    failed = upload_errors.select(*_KEY).union(validation_errors.select(*_KEY)).distinct()
    done = uploads.where(F.col("status") == COMPLETED).select(*_KEY)
    return failed.join(done, _KEY, "left_anti")


def recovered_partitions(errors: DataFrame, uploads: DataFrame) -> DataFrame:
    """Failures whose partition was uploaded after all, with both times."""
    success = uploads.select(*_KEY, F.col("uploaded_at").alias("success_at"))
    failures = errors.withColumnRenamed("created_at", "failed_at")
    return join_lookup(failures, success, _KEY, "inner").select(*_KEY, "failed_at", "success_at")


def partitions_never_uploaded(errors: DataFrame, uploads: DataFrame) -> DataFrame:
    """Errored partitions that no upload record names, whatever its status."""
    return errors.select(*_KEY).distinct().join(uploads.select(*_KEY).distinct(), _KEY, "left_anti")


def rebuild_uploads(objects: DataFrame, uploaded_at: Column, event_seq: Column) -> DataFrame:
    """Upload records from an object listing (``key``, ``size``).

    Keys of other shapes are left out; of several objects in one partition the
    one listed last, by key, stands for it. Counts are unknown: zero and null.
    """
    parsed = objects.withColumn("_p", parse_key(F.col("key"))).where(F.col("_p").isNotNull())
    records = parsed.select("_p.exporter", "_p.partition_value", F.col("key").alias("s3_key"), "_p.file_name", "size")
    return newest_per_key(records, _KEY, ["s3_key"]).select(
        *_KEY,
        "s3_key",
        "file_name",
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(None).cast("bigint").alias("min_slot"),
        F.lit(None).cast("bigint").alias("max_slot"),
        F.coalesce("size", F.lit(0)).cast("bigint").alias("file_size"),
        uploaded_at.cast("timestamp").alias("uploaded_at"),
        F.lit(COMPLETED).alias("status"),
        event_seq.cast("bigint").alias("event_seq"),
    )


def next_suffixes(uploads: DataFrame, day: str) -> DataFrame:
    """Number of the next snapshot of ``day`` per exporter: those so far plus one."""
    of_day = F.col("partition_value").startswith(f"{day}.")
    return uploads.groupBy("exporter").agg((F.count_if(of_day) + 1).alias("next_suffix"))


def current_runs(events: DataFrame) -> DataFrame:
    """The latest record of every run; its completion replaces its start."""
    return newest_per_key(events, ["run_id"], ["event_seq"])


def last_watermarks(runs: DataFrame, mode: str = "latest") -> DataFrame:
    """Source watermark per exporter from completed runs that set one.

    ``latest`` takes the newest run's, which a filtered backfill can move back;
    ``max`` takes the furthest, comparing numbers as numbers.
    """
    usable = runs.where((F.col("status") == COMPLETED) & F.col("source_data_watermark").isNotNull())
    mark = F.col("source_data_watermark")
    by_value = F.struct(whole_number(mark), mark)
    rank = F.struct(F.col("run_id"), mark) if mode == "latest" else by_value
    return usable.groupBy("exporter").agg(F.max_by(mark, rank).alias("source_data_watermark"))


def run_summary(results: DataFrame) -> DataFrame:
    """Counts per exporter of one run's partition results.

    ``results`` has one row per scanned partition with ``exporter`` and
    ``outcome``: skipped, uploaded, invalid, or upload_failed, plus
    ``was_validated``.
    """
    outcome = F.col("outcome")
    return results.groupBy("exporter").agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(outcome == "skipped").alias("skipped_existing"),
        F.count_if(F.col("was_validated")).alias("validated"),
        F.count_if(outcome == "invalid").alias("validation_errors"),
        F.count_if(outcome == "uploaded").alias("uploaded"),
        F.count_if(outcome == "upload_failed").alias("upload_errors"),
    )
