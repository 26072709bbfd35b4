"""Versioned whole-table snapshots."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from partflow.sources.partitions import POINTERS, latest_snapshot, pointers
from partflow.sources.storage import Move, Storage

_STAGING = "_staging-"


def write_snapshot(rows: DataFrame, root: str, label: str, order: str) -> int:
    """Write ``rows`` sorted by ``order`` as ``snapshot=label`` and make it the current one; returns their number.

    A table that was read to compute ``rows`` cannot be overwritten, so every
    snapshot has its own directory (that of a label in use gets a suffix), which appears
    by a rename once complete. The last step switches the pointer: until then readers
    have the snapshot before, so one whose writer died is never read in part or by
    chance. Nothing is left behind for an empty result.
    """
    spark = rows.sparkSession
    storage, unique = Storage(spark), uuid.uuid4().hex
    staging = f"{root}/{_STAGING}{unique}"
    rows.orderBy(order).write.parquet(staging)
    written = spark.read.schema(rows.schema).parquet(staging).count()
    if not written:
        storage.delete(staging)
        return 0
    name = f"snapshot={label}"
    if storage.exists(f"{root}/{name}"):
        name = f"{name}-{unique[:12]}"
    storage.replace(Move(staging, f"{root}/{name}"))
    point_to(spark, root, name)
    return written


def point_to(spark: SparkSession, root: str, name: str) -> None:
    """Make the snapshot in the directory ``name`` the current one, a former one included (going back to it).

    Pointers are numbered, and no two writers get the same number: the greatest counts.
    """
    storage = Storage(spark)
    number = max((n for n, _ in pointers(spark, root)), default=0) + 1
    while not storage.claim(f"{root}/{POINTERS}/{number:06d}", name):
        number += 1


def clean_snapshots(spark: SparkSession, root: str, keep: dt.timedelta) -> list[str]:
    """Delete snapshots that ceased to be current longer than ``keep`` ago; returns their names.

    The current one stays whatever its age. One that no pointer ever named counts from
    when it was written, as does what broken-off writers staged. ``keep`` has to be
    longer than the longest job that reads a snapshot, and than the writing of one.
    """
    storage, limit = Storage(spark), time.time() - keep.total_seconds()
    current, named = latest_snapshot(spark, root), pointers(spark, root)
    switched = {int(p.rsplit("/", 2)[1]): at for p, at in storage.modified(f"{root}/{POINTERS}/*/by-*").items()}
    ended = {}
    for (_, name), (following, _) in zip(named, named[1:]):
        ended[name] = switched[following]  # the last time it ceased to be current
    deleted = []
    for path, written in sorted({**storage.modified(f"{root}/snapshot=*"), **storage.modified(f"{root}/{_STAGING}*")}.items()):
        name = path.rsplit("/", 1)[1]
        if path != current and ended.get(name, written) < limit:
            storage.delete(path)
            deleted.append(name)
    return deleted
