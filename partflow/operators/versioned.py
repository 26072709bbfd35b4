"""Reference data that grows by versions: which keys to look up, which number they get."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.text import whole_number


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    """All keys, in order."""
    return rows.select(key).distinct().orderBy(key)


def keys_since(rows: DataFrame, key: str, day: Column, watermark: str | None) -> DataFrame:
    """Keys in partitions after the watermark; none without a watermark.

    On a partition column the comparison prunes the scan.
    """
    later = F.lit(False) if watermark is None else day > F.lit(watermark)
    return rows.where(later).select(key).distinct()


def max_versions(exports: DataFrame, key: str) -> DataFrame:
    """Highest version of every key over all earlier exports."""
    return exports.groupBy(key).agg(F.max("version").alias("max_version"))


def last_export(partition: Column) -> Column:
    """Aggregate: the latest partition, comparing epochs as numbers; null when there is none."""
    text = partition.cast("string")
    return F.max(F.struct(whole_number(text).alias("number"), text.alias("text")))["text"]


def candidates(registered: DataFrame, exported: DataFrame, since: DataFrame, key: str, rebuild: bool = False) -> DataFrame:
    """Keys to look up: all of them on a rebuild, else the unexported and the re-registered."""
    everything = registered.select(key).distinct()
    if rebuild:
        return everything
    unexported = everything.join(exported.select(key).distinct(), key, "left_anti")
    return unexported.union(since.select(key)).distinct()


def assign_versions(resolved: DataFrame, versions: DataFrame, key: str, rebuild: bool = False) -> DataFrame:
    """Successful rows with their ``version``: one on a rebuild, else one above the highest."""
    kept = resolved.where("success")
    if rebuild:
        return kept.withColumn("version", F.lit(1))
    return (
        kept.join(versions, key, "left")
        .withColumn("version", (F.coalesce("max_version", F.lit(0)) + 1).cast("int"))
        .drop("max_version")
    )
