"""New partitions as a file stream: every file is seen once, whenever the job runs.

The stream's checkpoint remembers the files already handled. ``availableNow``
works off what is there and stops, so a scheduler can start the job as often as
it likes; a batch that is repeated after a failure overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.frames import empty_frame
from partflow.operators.stats import partition_stats
from partflow.sources.storage import exists, is_directory
from partflow.spec import flat_schema

_STATS_SCHEMA = flat_schema("partition_value string, row_count bigint, min_slot bigint, max_slot bigint")

# Fixed value: the schema every file listing has.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files below ``path``, or the single file at it, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if is_directory(spark, path):
        return reader.option("pathGlobFilter", "*.parquet").parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def listing_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """``path`` of parquet files below ``root`` as a stream; the files are listed, not read."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("pathGlobFilter", "*.parquet").load(root).select("path")


def each_new_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Call ``handle(rows, batch_id)`` for everything not seen before, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def collect_stats(stream: DataFrame, partition: Column, slot: Column, state: str, checkpoint: str) -> DataFrame:
    """Statistics of all partitions the stream has ever shown.

    Each batch leaves its partial statistics below ``state``, one row per
    partition; the result adds them up, so no batch reads old data again.
    """

    def keep(rows: DataFrame, batch_id: int) -> None:
        partition_stats(rows, partition, slot).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    each_new_batch(stream, checkpoint, keep)
    return stats_so_far(stream.sparkSession, state)


def stats_so_far(spark: SparkSession, state: str) -> DataFrame:
    """Sum of the partial statistics below ``state``."""
    if not exists(spark, state):
        return empty_frame(spark, _STATS_SCHEMA)
    parts = spark.read.schema(_STATS_SCHEMA).option("recursiveFileLookup", True).parquet(state)
    return parts.groupBy("partition_value").agg(
        F.sum("row_count").alias("row_count"), F.min("min_slot").alias("min_slot"), F.max("max_slot").alias("max_slot")
    )
