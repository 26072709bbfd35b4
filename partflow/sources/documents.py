"""Landed documents: registry files and answers of metadata services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.sources.storage import exists, qualified
from partflow.spec import RESPONSE_SCHEMA, flat_schema

#: Beyond so many tasks a core, a task takes several of the splits that Spark makes of the files, this many at most.
_TASKS_PER_CORE, _SPLITS_AT_ONCE = 4, 16


def read_documents(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Whole text files below ``root`` as ``path`` (relative to it) and ``content``."""
    if not exists(spark, root):
        return empty_frame(spark, flat_schema("path string, content string"))
    prefix = qualified(spark, root).rstrip("/") + "/"
    location = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    found = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root, wholetext=True)
        .select(location.alias("_at"), F.col("value").alias("content"))
        .select(F.expr(f"substring(_at, {len(prefix) + 1})").alias("path"), "content")
    )
    # Spark counts megabytes for opening each file, so small ones give a task for every few of them
    tasks, enough = found.rdd.getNumPartitions(), _TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return found.coalesce(max(enough, -(-tasks // _SPLITS_AT_ONCE))) if tasks > enough else found


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """Landed responses (parquet); empty when none have landed."""
    if not exists(spark, root):
        return empty_frame(spark, RESPONSE_SCHEMA)
    return spark.read.schema(RESPONSE_SCHEMA).option("recursiveFileLookup", True).parquet(root)
