"""Rewrite partitions whose measures differ from the authority's."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.operators import measures as algebra
from partflow.operators.selection import COMPLETED
from partflow.scratch import materialise
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import HIVE, move_staged, partition_directory, published_objects, stage_partitions, verify_published
from partflow.sources.inventory import inventory
from partflow.sources.storage import Retry, Storage
from partflow.spec import DatasetSpec, flat_schema

_RESULT = flat_schema("exporter string, partition_value string, wrong_rows bigint, outcome string, error_details string")
_MOVED = flat_schema("partition_value string, attempts int, error string")


def _as_filed(spark: SparkSession, base: str, spec: DatasetSpec, values: Sequence[str]) -> DataFrame:
    """Rows of Hive partitions with the columns their files have, and ``partition_value``."""
    folders = [partition_directory(base, spec, value, HIVE) for value in values]
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*folders)
    return rows.withColumn("partition_value", F.regexp_extract(F.col("_metadata.file_path"), f"/{spec.partition_column}=([^/]+)/[^/]+$", 1))


def rewrite_measures(
    spark: SparkSession,
    base: str,
    spec: DatasetSpec,
    authority: DataFrame,
    key: str,
    ledger: Ledger,
    now: dt.datetime,
    measures: Sequence[str] = algebra.MEASURES,
    dry_run: bool = False,
    retry: Retry = Retry(),
    storage: Callable[[SparkSession], Storage] = Storage,
) -> DataFrame:
    """Put the authority's measures into the partitions below ``base`` that have others.

    Only partitions with a row that differs from its authority are written: their files'
    types, column order and other columns stay, and rows the authority does not know stay
    as they are. They are staged beside the dataset, read back and compared, and moved in
    the place of the partitions they were read from; of a replacement that is cut short
    the next run brings the old partition back and corrects it then. The new files are
    recorded as uploads of the dataset, what failed as upload errors.

    Returns one row per partition that differed: ``exporter, partition_value,
    wrong_rows, outcome`` (``corrected``, ``failed``, or ``pending`` on a dry run).
    """
    own = storage(spark)
    own.restore(f"{base}/{spec.name}")
    listed = materialise(inventory(spark, base, spec), "inventory")
    values = sorted(row.partition_value for row in listed.select("partition_value").toLocalIterator())
    if not values:
        return empty_frame(spark, _RESULT)
    wrong = algebra.wrong_rows(_as_filed(spark, base, spec, values), authority, key, measures)
    wrong = materialise(wrong.groupBy("partition_value").agg(F.count("*").alias("wrong_rows")), "wrong")
    chosen = sorted(row.partition_value for row in wrong.toLocalIterator())
    result = wrong.select(F.lit(spec.name).alias("exporter"), "partition_value", "wrong_rows")
    nothing = F.lit(None).cast("string").alias("error_details")
    if dry_run or not chosen:
        return result.select("*", F.lit("pending").alias("outcome"), nothing)

    run = ledger.start_run(f"{spec.name}_correction", now)
    with ledger.closing(run, now, len(chosen)):
        rows = _as_filed(spark, base, spec, chosen)
        expected = rows.groupBy("partition_value").agg(F.count("*").alias("row_count"))
        staging = stage_partitions(algebra.correct_known_measures(rows, authority, key, measures), base)
        staged = spark.read.schema(rows.schema).parquet(staging)
        left = algebra.wrong_rows(staged, authority, key, measures).groupBy("partition_value").agg(F.count("*").alias("still_wrong"))
        found = staged.groupBy("partition_value").agg(F.count("*").alias("row_count"))
        checked = verify_published(expected, found).join(left, "partition_value", "left")
        checked = materialise(checked.withColumn("is_published", F.col("is_published") & F.col("still_wrong").isNull()), "verified")
        whole = {row.partition_value for row in checked.where("is_published").select("partition_value").toLocalIterator()}
        moved = move_staged(own, staging, base, spec, HIVE, whole, retry)
        went = materialise(spark.createDataFrame([(v, m.attempts, m.error) for v, m in moved.items()], _MOVED), "moves")
        done = sorted(value for value, one in moved.items() if one.error is None)
        stamp = {"exporter": F.lit(spec.name), "event_seq": F.lit(run.run_id)}
        arrived = went.where("error IS NULL").join(checked, "partition_value")
        uploads = arrived.join(published_objects(spark, base, spec, done, HIVE), "partition_value").withColumns(
            {**stamp, "file_name": F.element_at(F.split("s3_key", "/"), -1), "uploaded_at": F.lit(now), "status": F.lit(COMPLETED)}
        )
        ledger.append("uploads", uploads)
        differs = F.lit("Correction failed: rows or measures differ in the staged files")
        lost = listed.join(wrong, "partition_value", "left_semi").join(arrived, "partition_value", "left_anti").join(went, "partition_value", "left")
        lost = lost.withColumns(
            {**stamp, "error_details": F.coalesce("error", differs), "attempts": F.coalesce("attempts", F.lit(1)), "created_at": F.lit(now)}
        )
        lost = materialise(lost, "lost")
        ledger.append("upload_errors", lost)
        failed = len(chosen) - len(done)
        error = None if not failed else f"{failed} partitions could not be corrected"
        ledger.complete_run(run, now, len(chosen), len(done), "completed" if not failed else "failed", error)
    outcome = F.when(F.col("error_details").isNull(), "corrected").otherwise("failed").alias("outcome")
    return result.join(lost.select("partition_value", "error_details"), "partition_value", "left").select(
        "exporter", "partition_value", "wrong_rows", outcome, "error_details"
    )
