"""Which partitions to work on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import text_column
from partflow.functions.keys import PartitionRange

COMPLETED = "completed"
PARTITION_KEY = ("exporter", "partition_value")


def requested_values(
    spark: SparkSession,
    partitions: Iterable[str] = (),
    value_range: PartitionRange | None = None,
) -> DataFrame | None:
    """Union of single values and a range; None when neither is given (keep all)."""
    listed = sorted(set(partitions))
    frames = []
    if listed:
        frames.append(text_column(spark, "partition_value", listed))
    if value_range is not None:
        frames.append(value_range.frame(spark))
    if not frames:
        return None
    wanted = frames[0]
    for frame in frames[1:]:
        wanted = wanted.union(frame)
    return wanted


def keep_requested(inventory: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Partitions among the wanted ones; values that do not exist drop out silently."""
    if wanted is None:
        return inventory
    keys = [name for name in PARTITION_KEY if name in wanted.columns]
    return inventory.join(wanted, keys, "left_semi")


def keep_pending(inventory: DataFrame, uploads: DataFrame) -> DataFrame:
    """Partitions without a completed upload."""
    done = uploads.where(F.col("status") == COMPLETED).select(*PARTITION_KEY)
    return inventory.join(done, list(PARTITION_KEY), "left_anti")
