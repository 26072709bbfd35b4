"""Move a published tree from ``date=``/``epoch=`` directories to bare ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.functions.keys import migrate_key
from partflow.plans.transfer import transfer_partitions
from partflow.scratch import materialise
from partflow.sinks.ledger_store import Ledger
from partflow.sources.inventory import inventory, list_objects
from partflow.sources.storage import Retry
from partflow.spec import DatasetSpec, flat_schema

_CHECKED = flat_schema(
    "exporter string, partition_value string, row_count bigint, found_row_count bigint,"
    " is_published boolean, error_details string, attempts int"
)


def planned_moves(objects: DataFrame) -> DataFrame:
    """Old and new key of every object whose key changes."""
    return (
        objects.select(F.col("key").alias("old_key"), migrate_key(F.col("key")).alias("new_key"))
        .where(F.col("old_key").rlike("^[^/]+/(date=[0-9]{4}-[0-9]{2}-[0-9]{2}|epoch=[0-9]+)/"))
        .where(F.col("old_key") != F.col("new_key"))
    )


def migrated_uploads(uploads: DataFrame) -> DataFrame:
    """Upload records whose key changes, with the new key."""
    key = migrate_key(F.col("s3_key"))
    return uploads.where(key != F.col("s3_key")).withColumn("s3_key", key)


def _migrate(spark: SparkSession, source: str, target: str, specs: list[DatasetSpec], retry: Retry) -> DataFrame:
    """One row per partition of all datasets; see :func:`migrate_layout`."""
    checks = empty_frame(spark, _CHECKED)
    for spec in specs:
        listed = materialise(inventory(spark, source, spec), "inventory")
        values = [row.partition_value for row in listed.select("partition_value").toLocalIterator()]
        if values:
            checked = transfer_partitions(spark, source, target, spec, spec, listed, values, retry=retry)
            checks = checks.unionByName(checked.withColumn("exporter", F.lit(spec.name)))
    return materialise(checks, "migration")


def migrate_layout(
    spark: SparkSession,
    source: str,
    target: str,
    specs: list[DatasetSpec],
    now: dt.datetime,
    ledger: Ledger | None = None,
    dry_run: bool = False,
    retry: Retry = Retry(),
) -> DataFrame:
    """Write every dataset anew under bare directories, each partition compared before it is moved into place.

    The old tree stays until its owner deletes it. A partition with a file that can't be
    read, or that does not arrive whole, takes no other with it. The ledger's keys change
    for the partitions that arrived; the run counts as failed if one did not. Returns the
    planned moves on a dry run, else one row per partition with ``is_published`` and
    ``error_details``; running it again does the same once more.
    """
    if dry_run:
        return planned_moves(list_objects(spark, source, "*.parquet"))
    if ledger is None:
        return _migrate(spark, source, target, specs, retry)
    run = ledger.start_run("layout_migration", now)
    with ledger.closing(run, now):
        checked = _migrate(spark, source, target, specs, retry)
        arrived = checked.where("is_published").select("exporter", "partition_value")
        moved = migrated_uploads(ledger.uploads()).join(arrived, ["exporter", "partition_value"], "left_semi")
        ledger.append("uploads", materialise(moved.withColumn("event_seq", F.lit(run.run_id)), "moved-keys"))
        n, n_arrived = checked.agg(F.count(F.lit(1)), F.count_if("is_published")).first()
        lost = f"{n - n_arrived} partitions did not arrive" if n_arrived < n else None
        ledger.complete_run(run, now, n, n_arrived, "failed" if lost else "completed", lost)
    return checked
