"""Publish partitions as they appear."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.plans.publish import PublishJob, Truth, publish_dataset
from partflow.scratch import materialise
from partflow.spec import DatasetSpec
from partflow.streaming.discover import each_new_batch, listing_stream


def publish_new_partitions(
    spark: SparkSession,
    job: PublishJob,
    spec: DatasetSpec,
    truth: Truth | None,
    now: dt.datetime,
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Run the publish job on the partitions of every batch of new files.

    A repeated batch is harmless: the ledger skips what has been published, and
    publishing replaces whole partitions. A file rewritten under its old name is
    not new; partitions that failed are the business of ``retry_failed``.
    """
    value = F.regexp_extract("path", f"/{spec.partition_column}=([^/]+)/[^/]+$", 1)

    def handle(files: DataFrame, batch_id: int) -> None:
        named = files.select(F.lit(spec.name).alias("exporter"), value.alias("partition_value"))
        wanted = materialise(named.distinct(), f"batch-{batch_id}")
        # a batch looks into its own directories only, whatever else the dataset holds
        values = sorted(row.partition_value for row in wanted.toLocalIterator())
        materialise(publish_dataset(spark, job, spec, truth, now, wanted, scanned=values), f"results-{batch_id}")

    each_new_batch(listing_stream(spark, f"{job.base}/{spec.name}", max_files), checkpoint, handle)
