"""Versioned reference data: pool metadata and the contract registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.frames import one_row
from partflow.functions.documents import resolve_pools
from partflow.operators import registry, versioned
from partflow.operators.keyed import remove_keys
from partflow.operators.profile import join_responses
from partflow.operators.selection import COMPLETED
from partflow.scratch import materialise, new_dir
from partflow.sinks.ledger_store import Ledger, Run
from partflow.sinks.versions import compact_versions, highest_versions
from partflow.sources.inventory import list_objects
from partflow.sources.partitions import read_partitions
from partflow.spec import DAILY, LEDGER_SCHEMAS, POOL_DATA_SCHEMA, REGISTRY_SCHEMA, DatasetSpec, flat_schema

POOL_REGISTRATIONS = DatasetSpec("pool_registration", "", "slot", DAILY)
POOL_DATA = "off_chain_pool_data"
REGISTRY = "smart_contract_registry"
_POOL_KEY = flat_schema("pool_id string")
_POOL, _CONTRACT = POOL_DATA_SCHEMA["pool_hash"], REGISTRY_SCHEMA["script_hash"]


def _export(rows: DataFrame, out: str, dataset: str, day: str, schema: T.StructType, name: str) -> DataFrame | None:
    """Write one export below its day; None, and nothing written, when there are no rows."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    ready = materialise(rows.select(*fields), dataset)
    if ready.isEmpty():
        return None
    ready.hint("rebalance").write.mode("overwrite").parquet(f"{out}/{dataset}/date={day}/export={name}")
    return ready


def _root(spark: SparkSession, out: str, run: Run | None) -> str:
    """Where an export goes: a dry run writes to a preview below the shared folder."""
    return out if run is not None else new_dir(spark, "preview")


def _name(run: Run | None) -> str:
    return "preview" if run is None else f"{run.run_id:09d}"


def _record(spark: SparkSession, ledger: Ledger, run: Run, out: str, dataset: str, row_count: int, now: dt.datetime) -> None:
    """Record an export that wrote rows as the upload of its day."""
    if not row_count:
        return
    day = now.date().isoformat()
    key = f"{dataset}/date={day}/export={_name(run)}"
    size = list_objects(spark, f"{out}/{key}", "*.parquet").agg(F.sum("size")).first()[0]
    record = {
        "exporter": dataset,
        "partition_value": day,
        "s3_key": key,
        "file_name": key.rsplit("/", 1)[1],
        "row_count": row_count,
        "file_size": size,
        "uploaded_at": now,
        "status": COMPLETED,
        "event_seq": run.run_id,
    }
    ledger.append("uploads", one_row(spark, LEDGER_SCHEMAS["uploads"], record))


def pool_candidates(
    spark: SparkSession, base: str, out: str, watermark: str | None, rebuild: bool = False
) -> DataFrame:
    """``pool_hash`` of every pool to look up."""
    registered = read_partitions(spark, base, POOL_REGISTRATIONS, schema=_POOL_KEY).select(
        F.col("pool_id").alias("pool_hash"), "partition_value"
    )
    exported = highest_versions(spark, out, POOL_DATA, _POOL)
    since = versioned.keys_since(registered, "pool_hash", F.col("partition_value"), watermark)
    return versioned.candidates(registered, exported, since, "pool_hash", rebuild)


def export_pools(
    spark: SparkSession,
    base: str,
    out: str,
    responses: DataFrame,
    ledger: Ledger,
    now: dt.datetime,
    rebuild: bool = False,
    dry_run: bool = False,
) -> DataFrame | None:
    """Export the pools that are new or registered again, one version up.

    Returns the exported rows, or None when nothing was due or nothing resolved.
    The watermark is the last registration day; a dry run leaves the ledger alone.
    """
    run = None if dry_run else ledger.start_run(POOL_DATA, now)
    with ledger.closing(run, now):
        return _pools(spark, base, out, responses, ledger, now, rebuild, run)


def _pools(
    spark: SparkSession, base: str, out: str, responses: DataFrame, ledger: Ledger, now: dt.datetime, rebuild: bool, run: Run | None
) -> DataFrame | None:
    watermark = ledger.watermark(POOL_DATA)
    due = materialise(pool_candidates(spark, base, out, watermark, rebuild), "pools-due")
    resolved = resolve_pools(join_responses(due, responses, "pool_hash").drop("fetched_at"))
    versions = highest_versions(spark, out, POOL_DATA, _POOL)
    numbered = versioned.assign_versions(resolved, versions, "pool_hash", rebuild)
    stamped = numbered.withColumn("fetched_at", F.lit(now))
    exported = _export(stamped, _root(spark, out, run), POOL_DATA, now.date().isoformat(), POOL_DATA_SCHEMA, _name(run))
    if run is not None:
        rows = read_partitions(spark, base, POOL_REGISTRATIONS, schema=_POOL_KEY)
        last_day = rows.agg(F.max("partition_value")).first()[0] if exported is not None else None
        n_exported = exported.count() if exported is not None else 0
        _record(spark, ledger, run, out, POOL_DATA, n_exported, now)
        compact_versions(spark, out, POOL_DATA, _POOL)
        ledger.complete_run(run, now, due.count(), n_exported, watermark=last_day)
    return exported


def export_registry(
    spark: SparkSession,
    out: str,
    files: dict[str, DataFrame],
    latest: DataFrame,
    ledger: Ledger,
    now: dt.datetime,
    changes: dict[str, DataFrame] | None = None,
    dry_run: bool = False,
    rebuild: bool = False,
) -> DataFrame | None:
    """Export the contracts of every source whose revision moved.

    ``files`` holds the landed files (``path``, ``content``) of each source and
    ``latest`` the landed revisions (``source``, ``latest_sha``). ``changes``
    holds the changed file names of a source where they are known; without them
    the source is read in full. The revision of a source advances once its files
    have been read, even if nothing in them changed; one whose files have not landed
    keeps its revision and is due again. ``rebuild`` reads every landed source in full.
    """
    changes = changes or {}
    known_diffs = F.col("source").isin(list(changes)) if changes else F.lit(False)
    plan = materialise(
        registry.revision_plan(latest.withColumn("diff_known", known_diffs), ledger.registry_state()), "revisions"
    )
    # one row per source, and the sources are the fixed few in registry.SOURCES
    modes = {r.source: r.mode for r in plan.where(F.col("source").isin(*registry.SOURCES)).toLocalIterator()}
    records, handled = None, [source for source, mode in modes.items() if mode == "skip"]
    for source in registry.SOURCES:
        mode = "full" if rebuild else modes.get(source)
        if mode in (None, "skip") or source not in files:
            continue
        handled.append(source)
        landed = files[source]
        if mode == "incremental":
            changed = registry.changed_files(changes[source], registry.PREFIXES[source])
            landed = landed.join(changed.select(F.col("filename").alias("path")).distinct(), "path", "left_semi")
        parsed = registry.PARSERS[source](landed, source)
        records = parsed if records is None else records.unionByName(parsed)

    run = None if dry_run else ledger.start_run(REGISTRY, now)
    with ledger.closing(run, now):
        return _contracts(spark, out, records, plan, handled, ledger, now, run)


def _contracts(
    spark: SparkSession, out: str, records: DataFrame | None, plan: DataFrame, handled: list[str], ledger: Ledger, now: dt.datetime, run: Run | None
) -> DataFrame | None:
    exported = None
    if records is not None:
        known = ledger.registry_hashes()
        best = registry.not_outranked(registry.best_source(records), known)
        best = materialise(best, "contracts")
        versions = highest_versions(spark, out, REGISTRY, _CONTRACT)
        numbered = versioned.assign_versions(best.withColumn("success", F.lit(True)), versions, "script_hash")
        stamped = numbered.withColumn("fetched_at", F.lit(now))
        exported = _export(stamped, _root(spark, out, run), REGISTRY, now.date().isoformat(), REGISTRY_SCHEMA, _name(run))
        if run is not None:
            seen = best.select("script_hash", "source").withColumns(
                {"first_seen_at": F.lit(now), "event_seq": F.lit(run.run_id)}
            )
            # the first source to bring a hash keeps it, so only unknown ones are added
            ledger.append("registry_hashes", remove_keys(seen, known, ["script_hash"]))
    if run is not None:
        state = plan.where(F.col("source").isin(handled)).select("source", F.col("latest_sha").alias("last_commit_sha")).withColumns(
            {"last_checked_at": F.lit(now), "event_seq": F.lit(run.run_id)}
        )
        ledger.append("registry_state", state)
        n = exported.count() if exported is not None else 0
        _record(spark, ledger, run, out, REGISTRY, n, now)
        compact_versions(spark, out, REGISTRY, _CONTRACT)
        ledger.complete_run(run, now, n, n)
    return exported
