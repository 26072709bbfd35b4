"""Which files of partitions cannot be read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.scratch import new_dir
from partflow.session import side_session
from partflow.spec import flat_schema

# Texts of the ledger.
UNREADABLE = "Parquet read error: unreadable file"
EMPTY = "Partition holds no rows"

_FAULTS = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "statistic")


def is_file_fault(error: Exception) -> bool:
    """Whether a failed job failed on a file's content, and not on the cluster, rights or memory."""
    text = str(error)
    if hasattr(error, "java_exception"):
        text += error.java_exception.toString()
        cause = error.java_exception.getCause()
        while cause is not None:
            text += cause.toString()
            cause = cause.getCause()
    return any(fault in text for fault in _FAULTS)


def _footer_is_readable(content: bytes) -> bool:
    try:
        pq.read_metadata(pa.BufferReader(content))
        return True
    except (pa.ArrowInvalid, OSError):
        return False


def broken_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` of the files among ``paths`` without a readable footer, found by executors in one job.

    Meant for files that gave no row: an empty file is little but its footer, a broken one
    is read as far as it goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            broken = [not _footer_is_readable(content or b"") for content in batch.column("content").to_pylist()]
            yield batch.select(["path"]).filter(pa.array(broken, pa.bool_()))

    if not paths:
        return empty_frame(spark, flat_schema("path string"))
    # a file is a batch, so a task holds one at a time
    one_by_one = side_session(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "1"})
    files = one_by_one.read.format("binaryFile").load(paths).select("path", "content")
    found = new_dir(spark, "broken-footers")
    files.mapInArrow(run, "path string").write.parquet(found)
    return spark.read.schema("path string").parquet(found)


def file_verdicts(files: DataFrame, found: DataFrame) -> DataFrame:
    """Partitions with a file that cannot be read, or without rows: ``partition_value, error_details``.

    ``files`` lists the files that count (``path``, ``partition_value``); ``found`` has
    ``path``, ``row_count`` (by the footer) and ``rows_read`` of those that could be read.
    A file whose pages break off counts as unreadable. Only files without rows are opened
    once more; their paths pass through the driver, as the paths of any read do. The
    number of jobs does not depend on how many files are broken.
    """
    spark = files.sparkSession
    beside = files.join(found, "path", "left")
    silent = [r.path for r in beside.where("row_count IS NULL").select("path").toLocalIterator()]
    broken = broken_footers(spark, silent)
    state = beside.join(broken.withColumn("_broken", F.lit(True)), "path", "left").withColumn(
        "_broken", F.coalesce("_broken", F.col("rows_read") < F.col("row_count"), F.lit(False))
    )
    per_partition = state.groupBy("partition_value").agg(
        F.bool_or("_broken").alias("_broken"), F.sum(F.coalesce("row_count", F.lit(0))).alias("_rows")
    )
    details = F.when(F.col("_broken"), UNREADABLE).when(F.col("_rows") == 0, EMPTY)
    return per_partition.select("partition_value", details.alias("error_details")).where("error_details IS NOT NULL")
