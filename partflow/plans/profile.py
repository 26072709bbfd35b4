"""Build or update the profile table from registrations and landed responses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.operators import profile
from partflow.scratch import materialise
from partflow.sinks.snapshots import clean_snapshots, write_snapshot
from partflow.sources.partitions import read_snapshot, read_with_source
from partflow.spec import DAILY, PROFILE_SCHEMA, REGISTRATION_SCHEMA, DatasetSpec

REGISTRATIONS = DatasetSpec("drep_registration", "", "slot", DAILY)
PROFILE_NAME = "drep_profile"


def pending_lookups(spark: SparkSession, base: str, out: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Keys a fetcher has to look up before :func:`build_profile` runs."""
    registrations = read_with_source(spark, base, REGISTRATIONS, REGISTRATION_SCHEMA, dates)
    existing = read_snapshot(spark, f"{out}/{PROFILE_NAME}", PROFILE_SCHEMA, ["drep_id", "source_block"])
    actions = profile.classify(profile.newest_registrations(registrations), existing)
    return actions.where(F.col("action") == profile.TO_RESOLVE).select("drep_id")


def build_profile(
    spark: SparkSession,
    base: str,
    out: str,
    responses: DataFrame,
    label: str,
    now: str,
    rebuild: bool = False,
    dates: Iterable[str] | None = None,
    dry_run: bool = False,
    keep: dt.timedelta | None = None,
) -> dict:
    """Merge registrations into the profile and write it as snapshot ``label``.

    A rebuild starts from nothing and reads all dates; an update reads the given
    ones. A dry run only counts what would be done. The new snapshot becomes the
    current one as the last step; with ``keep``, snapshots that ceased to be so longer ago
    are deleted after it.
    """
    root = f"{out}/{PROFILE_NAME}"
    existing = (
        empty_frame(spark, PROFILE_SCHEMA) if rebuild else read_snapshot(spark, root, PROFILE_SCHEMA)
    )
    before = existing.count()
    registrations = read_with_source(
        spark, base, REGISTRATIONS, REGISTRATION_SCHEMA, None if rebuild else dates
    )
    newest = materialise(profile.newest_registrations(registrations), "newest-registrations")
    summary = {"profiles_before": before, "profiles_after": before, "keys_read": newest.count()}
    if not summary["keys_read"]:
        return summary
    actions = profile.classify(newest, existing).groupBy("action").count()
    summary["actions"] = {row.action: row["count"] for row in actions.toLocalIterator()}
    if dry_run:
        return summary
    merged = profile.merge_profiles(existing, profile.answered_batch(newest, responses), now)
    summary["profiles_after"] = write_snapshot(merged, root, label, "drep_id")
    if keep is not None:
        summary["snapshots_deleted"] = clean_snapshots(spark, root, keep)
    return summary
