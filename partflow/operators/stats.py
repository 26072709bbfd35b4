"""Counts and slot ranges per partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_stats(
    rows: DataFrame,
    partition: Column,
    slot: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Row count, and slot range where there is a slot, of all partitions in one pass.

    The scan reads the partition and slot columns only. Partial aggregation
    leaves one row per partition and task before the shuffle.
    """
    measures = [F.count(F.lit(1)).alias("row_count")]
    if slot is not None:
        measures += [F.min(slot).alias("min_slot"), F.max(slot).alias("max_slot")]
    return rows.groupBy(*by, partition.alias("partition_value")).agg(*measures)


def truth_day_bounds(
    blocks: DataFrame, day: Column, slot: Column, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Slot range of the truth per day: of all days, or of those from ``first`` to ``last``.

    The limits reach the scan where ``day`` is a column of the source.
    """
    if first is not None and last is not None:
        blocks = blocks.where(day.between(first, last))
    return blocks.groupBy(day.alias("partition_value")).agg(
        F.min(slot).alias("block_min"), F.max(slot).alias("block_max")
    )


def truth_epoch_counts(
    truth: DataFrame, epoch: Column, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Row count of the truth per epoch: of all epochs, or of those from ``first`` to ``last``.

    The limits are compared as numbers with the source's own column, which its scan prunes by.
    """
    if first is not None and last is not None:
        truth = truth.where(epoch.between(first, last))
    return truth.groupBy(epoch.cast("string").alias("partition_value")).agg(
        F.count(F.lit(1)).alias("pg_count")
    )
