"""Derived datasets: widen all pending partitions of a source and publish the result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.operators.enrich import Enrichment, enrich
from partflow.operators.selection import COMPLETED, keep_pending, keep_requested
from partflow.plans.transfer import transfer_partitions
from partflow.scratch import materialise, new_dir
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import BARE, published_objects
from partflow.sources.inventory import inventory
from partflow.sources.partitions import read_snapshot
from partflow.sources.storage import Retry
from partflow.spec import EPOCH, PROFILE_SCHEMA, DatasetSpec

PROFILE_COLUMNS = ("anchor_url", "drep_name")


def profile_enrichment(spark: SparkSession, out: str) -> Enrichment:
    """``drep_dist`` with URL and name of the newest profile; nulls while there is none."""
    profile = read_snapshot(spark, f"{out}/drep_profile", PROFILE_SCHEMA, ["drep_id", *PROFILE_COLUMNS])
    return Enrichment(
        "drep_dist_enriched", "drep_dist", lambda fact: enrich(fact, profile, "drep_id", PROFILE_COLUMNS)
    )


def run_enrichment(
    spark: SparkSession,
    job: Enrichment,
    base: str,
    target: str,
    ledger: Ledger,
    now: dt.datetime,
    wanted: DataFrame | None = None,
    dry_run: bool = False,
    layout: str = BARE,
    schema: T.StructType | None = None,
    retry: Retry = Retry(),
) -> dict:
    """Enrich the partitions the ledger does not have under the derived name.

    The watermark is the furthest partition handled, epochs compared as numbers;
    a dry run writes the data to a preview below the shared folder, but no upload
    and no watermark. A partition with a file that can't be read, or that does not
    arrive whole, is an upload error and takes no other with it.
    """
    source = DatasetSpec(job.source, "", "", job.partition_type)
    derived = DatasetSpec(job.name, "", "", job.partition_type)
    listed = materialise(inventory(spark, base, source), "source-inventory")
    named = listed.withColumn("exporter", F.lit(job.name))
    requested = keep_requested(named, wanted)
    pending = materialise(keep_pending(requested, ledger.uploads()), "pending")
    values = [row.partition_value for row in pending.select("partition_value").toLocalIterator()]
    counts = listed.join(requested.select("partition_value", F.lit(1).alias("_r")), "partition_value", "left")
    scanned, n_requested = counts.agg(F.count(F.lit(1)), F.count("_r")).first()
    summary = {
        "scanned": scanned,
        "skipped_existing": n_requested - len(values),
        "enriched": len(values),
        "uploaded": 0,
        "errors": 0,
    }
    run = None if dry_run else ledger.start_run(job.name, now)
    if not values:
        if run is not None:
            ledger.complete_run(run, now, 0, 0)
        return summary

    try:
        where = new_dir(spark, "preview") if run is None else target
        checked = transfer_partitions(spark, base, where, source, derived, listed, values, job.transform, layout, schema, retry)
        if run is None:
            return summary
        uploads = (
            checked.where("is_published")
            .join(published_objects(spark, target, derived, values, layout), "partition_value")
            .select(
                F.lit(job.name).alias("exporter"),
                "partition_value",
                "s3_key",
                F.element_at(F.split("s3_key", "/"), -1).alias("file_name"),
                "row_count",
                "file_size",
                F.lit(now).alias("uploaded_at"),
                F.lit(COMPLETED).alias("status"),
                F.lit(run.run_id).alias("event_seq"),
            )
        )
        ledger.append("uploads", uploads)
        summary["uploaded"] = checked.where("is_published").count()
        summary["errors"] = len(values) - summary["uploaded"]
        if summary["errors"]:
            lost = checked.where("NOT is_published").join(listed.drop("error_details"), "partition_value")
            ledger.append(
                "upload_errors",
                lost.select(
                    F.lit(job.name).alias("exporter"),
                    "partition_value",
                    "file_path",
                    "file_size",
                    "error_details",
                    "attempts",
                    F.lit(now).alias("created_at"),
                    F.lit(run.run_id).alias("event_seq"),
                ),
            )
    except Exception as error:
        if run is not None:
            ledger.complete_run(run, now, len(values), 0, "failed", f"{type(error).__name__}: {str(error)[:500]}")
        raise
    furthest = max(values, key=int) if job.partition_type == EPOCH else max(values)
    ok = summary["errors"] == 0
    ledger.complete_run(
        run,
        now,
        summary["enriched"],
        summary["uploaded"],
        "completed" if ok else "failed",
        None if ok else f"{summary['errors']} partitions differ at the target",
        furthest if ok else None,
    )
    return summary
