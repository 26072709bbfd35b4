"""Write partitions of one tree into another, whole ones only."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.scratch import materialise
from partflow.sinks.partitions import BARE, move_staged, stage_partitions, staged_stats, stays_in_place, verify_published
from partflow.sources.inventory import inventory_files
from partflow.sources.partitions import file_stats, footer_stats, read_partitions
from partflow.sources.probe import EMPTY, file_verdicts, is_file_fault
from partflow.sources.storage import Retry, Storage
from partflow.spec import DatasetSpec

_DIFFERS = "Upload verification failed: rows differ at the target"
_MOVED = "partition_value string, attempts int, error string"


def _by_footers(spark: SparkSession, base: str, source: DatasetSpec, pending: DataFrame, values: list[str]) -> DataFrame | None:
    """Rows of each partition by its footers; None where these don't suffice."""
    if not pending.where(F.col("is_canonical") & (F.col("file_count") > 1)).isEmpty():
        return None
    try:
        return footer_stats(spark, base, source, values)
    except (PySparkException, Py4JError) as error:
        if not is_file_fault(error):
            raise
        return None


def transfer_partitions(
    spark: SparkSession,
    base: str,
    target: str,
    source: DatasetSpec,
    derived: DatasetSpec,
    listed: DataFrame,
    values: list[str],
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    layout: str = BARE,
    schema: T.StructType | None = None,
    retry: Retry = Retry(),
) -> DataFrame:
    """Write partitions of ``source`` as ``derived``; ``transform`` keeps the number of rows of each.

    What was staged is read back and compared with the source before it is moved into
    place. Returns a row for every partition: ``partition_value, row_count,
    found_row_count, is_published, error_details, attempts``. One with a file that can't be
    read, or that does not arrive whole, takes no other with it, and what the target has
    of it stays.
    """
    rows = read_partitions(spark, base, source, values, schema, True, listed=listed)
    pending = listed.where(F.col("partition_value").isin(values))

    expected, faults = _by_footers(spark, base, source, pending, values), None
    if expected is None:
        files = materialise(file_stats(rows), "file-stats")
        expected = files.groupBy("partition_value").agg(F.sum("row_count").alias("row_count"))
        faults = materialise(file_verdicts(inventory_files(spark, base, pending), files.drop("partition_value")), "faults")
    wide = transform(rows)
    staging = stage_partitions(wide, target, arranged=stays_in_place(wide))
    checked = verify_published(expected, staged_stats(wide, staging))
    if faults is None:
        checked = checked.withColumn("error_details", F.lit(None).cast("string"))
    else:
        checked = checked.join(faults, "partition_value", "full_outer")
    whole = F.coalesce("is_published", F.lit(False)) & F.col("error_details").isNull()
    checked = checked.withColumn("is_published", whole).withColumn(
        "error_details", F.when(~whole, F.coalesce("error_details", F.when(F.col("row_count") == 0, EMPTY), F.lit(_DIFFERS)))
    )
    checked = materialise(checked, "verified")
    arrived = {row.partition_value for row in checked.where("is_published").select("partition_value").toLocalIterator()}
    moved = move_staged(Storage(spark), staging, target, derived, layout, arrived, retry)
    went = spark.createDataFrame([(value, one.attempts, one.error) for value, one in moved.items()], _MOVED)
    return materialise(
        checked.join(went, "partition_value", "left").select(
            "partition_value",
            "row_count",
            "found_row_count",
            (F.col("is_published") & F.col("error").isNull()).alias("is_published"),
            F.coalesce("error", "error_details").alias("error_details"),
            F.coalesce("attempts", F.lit(1)).alias("attempts"),
        ),
        "moved",
    )
