"""Publish the valid, not yet published partitions of a dataset, and retry failures."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.frames import empty_frame, one_row
from partflow.operators.ledger import run_summary
from partflow.operators.reconcile import reconcile_daily, reconcile_epoch
from partflow.operators.selection import COMPLETED, keep_pending, keep_requested
from partflow.operators.stats import truth_day_bounds, truth_epoch_counts
from partflow.scratch import materialise
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import BARE, move_staged, published_objects, stage_partitions, staged_stats, verify_published
from partflow.sources.inventory import inventory, inventory_files
from partflow.sources.partitions import file_stats, footer_stats, read_partitions
from partflow.sources.probe import file_verdicts, is_file_fault
from partflow.sources.storage import Retry, Storage
from partflow.spec import DAILY, DatasetSpec, flat_schema, select_datasets

logger = logging.getLogger(__name__)

_VERDICT = flat_schema(
    "pq_count bigint, pg_count bigint, pq_min_slot bigint, pq_max_slot bigint,"
    " pg_min_slot bigint, pg_max_slot bigint, error_details string"
)


_RESULT = flat_schema("exporter string, partition_value string, outcome string, was_validated boolean")
_NAME = flat_schema("exporter string")
_MOVED = flat_schema("partition_value string, attempts int, error string")


@dataclass(frozen=True)
class Truth:
    """The table of record of a dataset, and the blocks that tell which slots a day has.

    Either is any DataFrame. Jobs filter its slots, its epochs, and its days where
    ``block_day`` is a column, to those at hand; such filters reach the source.
    """

    rows: DataFrame
    blocks: DataFrame | None = None
    block_slot: str = "slot"
    block_day: Column | None = None


@dataclass(frozen=True)
class PublishJob:
    """Where a dataset is read, published and recorded.

    ``schema`` saves looking for it in the files; ``retry`` says how often a partition that
    can't be put in its place is tried again.
    """

    base: str
    target: str
    ledger: Ledger
    schema: T.StructType | None = None
    layout: str = BARE
    retry: Retry = Retry()
    storage: Callable[[SparkSession], Storage] = Storage


def _values(frame: DataFrame) -> list[str]:
    # partition values: as many as there are directories, which the file index
    # of the read that follows holds on the driver anyway
    return [row.partition_value for row in frame.select("partition_value").toLocalIterator()]


def _statistics(job: PublishJob, spec: DatasetSpec, pending: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Statistics of the pending partitions, and those with faults (``partition_value, error_details``; None: none).

    Footers are asked first. Where a file has none, is empty or lacks statistics, all
    files are read one by one and those that can't be, or that break off, are named.
    """
    spark = pending.sparkSession
    values = _values(pending)
    slot = spec.slot_column if spec.partition_type == DAILY else None
    if pending.where(F.col("is_canonical") & (F.col("file_count") > 1)).isEmpty():
        try:
            return footer_stats(spark, job.base, spec, values, slot), None
        except (PySparkException, Py4JError) as error:
            if not is_file_fault(error):
                raise
            logger.info("%s: footers do not suffice, scanning", spec.name)
    rows = read_partitions(spark, job.base, spec, values, job.schema, True, listed=pending)
    files = materialise(file_stats(rows, slot), "file-stats")
    measures = [F.sum("row_count").alias("row_count")]
    if slot is not None:
        measures += [F.min("min_slot").alias("min_slot"), F.max("max_slot").alias("max_slot")]
    stats = materialise(files.groupBy("partition_value").agg(*measures), "stats")
    faults = file_verdicts(inventory_files(spark, job.base, pending), files.drop("partition_value"))
    return stats, materialise(faults, "faults")


def _truth_verdicts(job: PublishJob, spec: DatasetSpec, stats: DataFrame, truth: Truth) -> DataFrame:
    """Verdicts of the truth, of which only the days or epochs at hand are read."""
    slot = F.col(spec.slot_column)
    if spec.partition_type == DAILY:
        first, last = stats.agg(F.min("partition_value"), F.max("partition_value")).first()
        day_bounds = truth_day_bounds(truth.blocks, truth.block_day, F.col(truth.block_slot), first, last)
        return reconcile_daily(stats, truth.rows, slot, day_bounds)
    number = F.col("partition_value").cast("bigint")
    first, last = stats.agg(F.min(number), F.max(number)).first()
    return reconcile_epoch(stats, truth_epoch_counts(truth.rows, slot, first, last))


def validate_partitions(job: PublishJob, spec: DatasetSpec, pending: DataFrame, truth: Truth | None) -> DataFrame:
    """Verdict and statistics of the pending partitions; ``error_details`` is null for valid ones.

    A partition with a file that cannot be read is invalid whatever the rest of it
    holds. Without ``truth`` only that is looked at. ``source_rows``, ``source_min``
    and ``source_max`` are what has to arrive at the target.
    """
    stats, faults = _statistics(job, spec, pending)
    if truth is not None:
        verdicts = _truth_verdicts(job, spec, stats, truth)
    else:
        verdicts = stats.select("partition_value", F.lit(None).cast("string").alias("error_details"))
    fields = [
        (F.col(f.name) if f.name in verdicts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in _VERDICT.fields
    ]
    verdicts = verdicts.select("partition_value", *fields)
    if faults is not None:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in _VERDICT.fields if f.name != "error_details"]
        verdicts = verdicts.join(faults, "partition_value", "left_anti").unionByName(
            faults.select("partition_value", *nothing, "error_details")
        )
    slots = [F.col(c).cast("bigint") if c in stats.columns else F.lit(None).cast("bigint") for c in ("min_slot", "max_slot")]
    source = stats.select(
        "partition_value", F.col("row_count").alias("source_rows"), slots[0].alias("source_min"), slots[1].alias("source_max")
    )
    return materialise(verdicts.join(source, "partition_value", "left"), "verdicts")


def publish_dataset(
    spark: SparkSession,
    job: PublishJob,
    spec: DatasetSpec,
    truth: Truth | None,
    now: dt.datetime,
    wanted: DataFrame | None = None,
    dry_run: bool = False,
    scanned: Iterable[str] | None = None,
) -> DataFrame:
    """Scan, select, validate, write, verify and record one dataset.

    Without ``truth`` validation is skipped: counts are recorded as zero and
    slots as null. A partition that fails takes no other with it: files that can't
    be read make it invalid, and one that does not arrive whole, or can't be put in its
    place after all attempts, is an upload error. With ``scanned`` only the directories of
    these partitions are listed, at the source and at the target.
    A run that ends with an exception is closed as failed. A dry run validates but
    writes nothing, neither data nor ledger.

    Returns one row per scanned partition with its ``outcome``.
    """
    ledger = job.ledger
    listed = materialise(inventory(spark, job.base, spec, scanned), "inventory")
    requested = keep_requested(listed, wanted)
    pending = materialise(keep_pending(requested, ledger.uploads()), "pending")

    if not pending.isEmpty():
        verdicts = validate_partitions(job, spec, pending, truth)
    else:
        unchecked = [F.lit(None).cast(f.dataType).alias(f.name) for f in _VERDICT.fields]
        verdicts = pending.select("partition_value", *unchecked)
    valid = _values(verdicts.where(F.col("error_details").isNull()))

    published: set[str] = set()
    if not dry_run:
        run = ledger.start_run(spec.name, now)
        try:
            stamp = [F.lit(now).alias("created_at"), F.lit(run.run_id).alias("event_seq")]
            invalid = verdicts.where(F.col("error_details").isNotNull())
            ledger.append("validation_errors", invalid.select(F.lit(spec.name).alias("exporter"), "*", *stamp))
            if valid:
                published = _write_and_record(spark, job, spec, listed, verdicts, valid, now, run.run_id)
        except Exception as error:
            ledger.complete_run(run, now, len(valid), 0, "failed", f"{type(error).__name__}: {str(error)[:500]}")
            raise
        ledger.complete_run(run, now, len(valid), len(published))

    checked = truth is not None
    arrived = F.lit(True) if dry_run else F.col("partition_value").isin(sorted(published))
    outcome = (
        F.when(F.col("_verdict").isNull(), F.when(F.col("_requested"), "skipped").otherwise("not_requested"))
        .when(F.col("_verdict.error_details").isNotNull(), "invalid")
        .when(arrived, "uploaded")
        .otherwise("upload_failed")
    )
    return (
        listed.join(requested.select("partition_value", F.lit(True).alias("_r")), "partition_value", "left")
        .withColumn("_requested", F.coalesce("_r", F.lit(False)))
        .join(verdicts.select("partition_value", F.struct("error_details").alias("_verdict")), "partition_value", "left")
        .select(
            "exporter",
            "partition_value",
            outcome.alias("outcome"),
            (F.lit(checked) & F.col("_verdict").isNotNull()).alias("was_validated"),
            F.col("_verdict.error_details").alias("error_details"),
        )
    )


def _write_and_record(
    spark: SparkSession,
    job: PublishJob,
    spec: DatasetSpec,
    listed: DataFrame,
    verdicts: DataFrame,
    valid: list[str],
    now: dt.datetime,
    run_id: int,
) -> set[str]:
    """Write the valid partitions, read back what was staged, publish and record what arrived whole."""
    slot = F.col(spec.slot_column) if spec.partition_type == DAILY else None
    rows = read_partitions(spark, job.base, spec, valid, job.schema, True, listed=listed)
    staging = stage_partitions(rows, job.target, arranged=True)
    good = verdicts.where(F.col("error_details").isNull())
    measures = {"row_count": "source_rows"} | ({} if slot is None else {"min_slot": "source_min", "max_slot": "source_max"})
    expected = good.select("partition_value", *[F.col(old).alias(new) for new, old in measures.items()])
    checked = materialise(verify_published(expected, staged_stats(rows, staging, slot)), "verified")
    arrived = checked.where("is_published").select("partition_value")
    moved = move_staged(job.storage(spark), staging, job.target, spec, job.layout, set(_values(arrived)), job.retry)
    went = materialise(spark.createDataFrame([(v, m.attempts, m.error) for v, m in moved.items()], _MOVED), "moves")
    arrived = went.where("error IS NULL").select("partition_value")
    published = {value for value, one in moved.items() if one.error is None}

    details = listed.join(good.select("partition_value"), "partition_value", "left_semi")
    sizes = published_objects(spark, job.target, spec, sorted(published), job.layout)
    uploads = (
        details.drop("file_size", "file_count")
        .join(arrived, "partition_value", "left_semi")
        .join(sizes, "partition_value")
        .join(good, "partition_value")
        .select(
            "exporter",
            "partition_value",
            "s3_key",
            F.element_at(F.split("s3_key", "/"), -1).alias("file_name"),
            F.coalesce("pq_count", F.lit(0)).alias("row_count"),
            F.col("pq_min_slot").alias("min_slot"),
            F.col("pq_max_slot").alias("max_slot"),
            "file_size",
            F.lit(now).alias("uploaded_at"),
            F.lit(COMPLETED).alias("status"),
            F.lit(run_id).alias("event_seq"),
        )
    )
    job.ledger.append("uploads", uploads)
    differs = F.lit("Upload verification failed: rows or slots differ at the target")
    lost = details.join(arrived, "partition_value", "left_anti").join(went, "partition_value", "left").select(
        "exporter",
        "partition_value",
        "file_path",
        "file_size",
        F.coalesce("error", differs).alias("error_details"),
        F.coalesce("attempts", F.lit(1)).alias("attempts"),
        F.lit(now).alias("created_at"),
        F.lit(run_id).alias("event_seq"),
    )
    job.ledger.append("upload_errors", lost)
    return published


def publish_all(
    spark: SparkSession,
    jobs: Mapping[str, tuple[PublishJob, Truth | None]],
    specs: Iterable[DatasetSpec],
    now: dt.datetime,
    names: Iterable[str] | None = None,
    group: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Publish the datasets of ``specs`` chosen by name or group, one after another.

    ``jobs`` has the job and the truth of each by name. Returns one summary row per
    dataset; where its run broke off, ``error_details`` says why and the counts are
    zero. No dataset stops another.
    """
    chosen, unknown = select_datasets(specs, names, group)
    unknown += [spec.name for spec in chosen if spec.name not in jobs]
    if unknown:
        raise ValueError(f"unknown datasets: {', '.join(unknown)}")
    summary = None
    for spec in chosen:
        error_details, results = None, None
        try:
            job, truth = jobs[spec.name]
            results = materialise(publish_dataset(spark, job, spec, truth, now, dry_run=dry_run), "results")
        except Exception as error:
            logger.exception("%s: the run broke off", spec.name)
            error_details = f"{type(error).__name__}: {str(error)[:500]}"
        counted = run_summary(results if results is not None else empty_frame(spark, _RESULT))
        row = one_row(spark, _NAME, {"exporter": spec.name}).join(counted, "exporter", "left")
        row = row.fillna(0).withColumn("error_details", F.lit(error_details).cast("string"))
        summary = row if summary is None else summary.unionByName(row)
    if summary is None:
        return run_summary(empty_frame(spark, _RESULT)).withColumn("error_details", F.lit(None).cast("string"))
    return summary


def retry_failed(
    spark: SparkSession,
    job: PublishJob,
    specs: dict[str, tuple[DatasetSpec, Truth | None]],
    now: dt.datetime,
    dry_run: bool = False,
) -> DataFrame | None:
    """Publish again what failed, and clear the errors of what now succeeded.

    ``specs`` names the datasets to retry; errors of others stay. Returns the
    summary per dataset, or None when nothing failed.
    """
    failed = materialise(job.ledger.failed(), "failed")
    names = [row.exporter for row in failed.select("exporter").distinct().orderBy("exporter").toLocalIterator()]
    summary = None
    for name in names:
        if name not in specs:
            continue
        spec, truth = specs[name]
        wanted = failed.where(F.col("exporter") == name)
        results = materialise(publish_dataset(spark, job, spec, truth, now, wanted, dry_run), "results")
        if not dry_run:
            seq = job.ledger.events("runs").agg(F.max("run_id")).first()[0]
            cleared = results.where(F.col("outcome") == "uploaded").select("exporter", "partition_value")
            job.ledger.append("cleared_errors", cleared.withColumn("event_seq", F.lit(seq)))
        part = run_summary(results.where(F.col("outcome") != "not_requested"))
        summary = part if summary is None else summary.union(part)
    return summary
