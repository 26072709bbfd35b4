"""Exported partitions against the truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.text import joined_messages
from partflow.operators.rangecount import count_in_ranges


def _count_mismatch(exported: Column, truth: Column) -> Column:
    return F.when(exported != truth, F.format_string("Row count mismatch: parquet=%d, pg=%d", exported, truth))


def reconcile_daily(
    stats: DataFrame,
    truth: DataFrame,
    truth_slot: Column,
    day_bounds: DataFrame,
) -> DataFrame:
    """Verdict on every daily partition in ``stats``.

    ``stats`` comes from ``partition_stats``, written out because it is read
    several times, and ``day_bounds`` from ``truth_day_bounds``. A partition is invalid when the truth knows nothing of
    its day, when the truth holds another number of rows in the partition's own
    slot range, or when that range leaves the day's. The last two can both apply.
    """
    found = count_in_ranges(truth, truth_slot, stats, "min_slot", "max_slot").join(
        day_bounds, "partition_value", "left"
    )
    known = F.col("block_min").isNotNull()
    outside = (F.col("min_slot") < F.col("block_min")) | (F.col("max_slot") > F.col("block_max"))
    problems = joined_messages(
        _count_mismatch(F.col("row_count"), F.col("in_range")),
        F.when(
            outside,
            F.format_string(
                "Slot range outside block range: pq=[%d,%d], blocks=[%d,%d]",
                *[F.col(name) for name in ("min_slot", "max_slot", "block_min", "block_max")],
            ),
        ),
    )
    nothing = F.concat(F.lit("No blocks found in PG for date "), F.col("partition_value"))
    unranged = F.lit("Partition holds no slots")
    return found.withColumn(
        "error_details",
        F.when(~known, nothing).when(F.col("min_slot").isNull(), unranged).otherwise(problems),
    ).select(
        "partition_value",
        F.col("row_count").alias("pq_count"),
        F.when(known, F.col("in_range")).alias("pg_count"),
        F.col("min_slot").alias("pq_min_slot"),
        F.col("max_slot").alias("pq_max_slot"),
        F.col("block_min").alias("pg_min_slot"),
        F.col("block_max").alias("pg_max_slot"),
        F.col("error_details").isNull().alias("is_valid"),
        "error_details",
    )


def reconcile_epoch(stats: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """Verdict on every epoch partition in ``stats``: equal row counts or not.

    Epochs that only the truth holds are no partitions and go unreported; see
    ``missing_epochs``.
    """
    pg_count = F.coalesce(F.col("pg_count"), F.lit(0))
    return (
        stats.join(truth_counts, "partition_value", "left")
        .withColumn("pg_count", pg_count)
        .withColumn("error_details", _count_mismatch(F.col("row_count"), F.col("pg_count")))
        .select(
            "partition_value",
            F.col("row_count").alias("pq_count"),
            "pg_count",
            F.col("error_details").isNull().alias("is_valid"),
            "error_details",
        )
    )


def missing_epochs(stats: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """Epochs of the truth without an exported partition."""
    return truth_counts.join(stats, "partition_value", "left_anti")


def suspect_partitions(inventory: DataFrame, stats: DataFrame) -> DataFrame:
    """Listed partitions that yielded no row: their files are empty or unreadable."""
    return inventory.join(stats.select("partition_value"), "partition_value", "left_anti")
