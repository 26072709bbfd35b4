"""Object keys, partition values and partition ranges.

Published objects are named ``{dataset}/{value}/{file}.parquet``; the older
layout writes ``date=`` or ``epoch=`` before the value.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.functions.text import whole_number
from partflow.spec import DAILY, EPOCH

# The shapes of partition values and of published keys.
DAY_SHAPE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
EPOCH_SHAPE = "[0-9]+"
KEY_SHAPE = f"^[^/]+/({DAY_SHAPE}|{EPOCH_SHAPE})/.+\\.parquet$"

_SECONDS_PER_DAY = 86_400


def day_text(moment: Column) -> Column:
    """Day of a date or timestamp as ``YYYY-MM-DD``.

    The cast through DATE leaves zone-less timestamps alone, so the session's
    time zone has no say for them.
    """
    return moment.cast("date").cast("string")


def day_of_epoch_seconds(seconds: Column) -> Column:
    """UTC day of a count of seconds since 1970, whatever the session's time zone."""
    days = F.floor(seconds / F.lit(_SECONDS_PER_DAY)).cast("int")
    return F.date_add(F.lit(dt.date(1970, 1, 1)), days)


def file_name(dataset: Column, value: Column, partition_type: Column) -> Column:
    """Canonical file name of a partition."""
    marker = F.when(partition_type == DAILY, F.lit("-")).otherwise(F.lit("-epoch-"))
    return F.concat(dataset, marker, value, F.lit(".parquet"))


def object_key(dataset: Column, value: Column, partition_type: Column) -> Column:
    """Published key of a partition."""
    return F.concat_ws("/", dataset, value, file_name(dataset, value, partition_type))


def parse_key(key: Column) -> Column:
    """Struct (exporter, partition_value, file_name) of a published key, else null.

    A ``.N`` suffix belongs to the file name, which may itself contain slashes.
    """
    pieces = F.split(key, "/", 3)
    return F.when(
        key.rlike(KEY_SHAPE),
        F.struct(
            pieces.getItem(0).alias("exporter"),
            pieces.getItem(1).alias("partition_value"),
            pieces.getItem(2).alias("file_name"),
        ),
    )


def migrate_key(key: Column) -> Column:
    """Key without the ``date=`` and ``epoch=`` markers in its directories."""
    undated = F.regexp_replace(key, f"/date=({DAY_SHAPE})/", "/$1/")
    return F.regexp_replace(undated, f"/epoch=({EPOCH_SHAPE})/", "/$1/")


def partition_type_of(value: Column) -> Column:
    """Partition type by the shape of the value; null for other shapes."""
    return F.when(value.rlike(f"^{DAY_SHAPE}$"), DAILY).when(value.rlike(f"^{EPOCH_SHAPE}$"), EPOCH)


def source_date(path: Column) -> Column:
    """The ``date=`` directory a file came from, or the empty text."""
    return F.regexp_extract(path, "date=([^/]+)", 1)


@dataclass(frozen=True)
class PartitionRange:
    """Inclusive range of partition values, of days or of epochs."""

    partition_type: str
    start: int | dt.date
    end: int | dt.date

    def frame(self, spark: SparkSession) -> DataFrame:
        """All values of the range as ``partition_value``, generated on the executors."""
        if self.partition_type == EPOCH:
            return spark.range(self.start, self.end + 1).select(
                F.col("id").cast("string").alias("partition_value")
            )
        days = (self.end - self.start).days
        return spark.range(days + 1).select(
            F.date_add(F.lit(self.start), F.col("id").cast("int")).cast("string").alias("partition_value")
        )


def parse_range(text: str) -> PartitionRange:
    """``A:B`` as a range of integers or, failing that, of ISO days.

    Raises ValueError for a missing colon, for other texts and for a start
    beyond the end.
    """
    start_text, colon, end_text = text.partition(":")
    if not colon:
        raise ValueError(f"range needs the form A:B, got {text!r}")
    if all(re.fullmatch(r"[+-]?[0-9]+", part.strip()) for part in (start_text, end_text)):
        found = PartitionRange(EPOCH, int(start_text), int(end_text))
    elif all(re.fullmatch(DAY_SHAPE, part) for part in (start_text, end_text)):
        found = PartitionRange(DAILY, dt.date.fromisoformat(start_text), dt.date.fromisoformat(end_text))
    else:
        raise ValueError(f"range {text!r} is neither N:N nor YYYY-MM-DD:YYYY-MM-DD")
    if found.start > found.end:
        raise ValueError(f"range {text!r} starts after its end")
    return found


def range_values(text: Column) -> Column:
    """Array of the partition values in an ``A:B`` text; null for a malformed one."""
    start = F.split_part(text, F.lit(":"), F.lit(1))
    end = F.split_part(text, F.lit(":"), F.lit(2))
    first_epoch, last_epoch = whole_number(start), whole_number(end)
    first_day, last_day = start.try_cast("date"), end.try_cast("date")
    as_text = lambda values: F.transform(values, lambda v: v.cast("string"))
    return F.when(
        text.rlike(f"^[+-]?{EPOCH_SHAPE}:[+-]?{EPOCH_SHAPE}$") & (first_epoch <= last_epoch),
        as_text(F.sequence(first_epoch, last_epoch)),
    ).when(
        text.rlike(f"^{DAY_SHAPE}:{DAY_SHAPE}$") & (first_day <= last_day),
        as_text(F.sequence(first_day, last_day)),
    )
