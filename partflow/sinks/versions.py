"""Highest versions of exported keys, kept compact beside the exports.

Exports only ever grow in number. What a run wants of all of them is one number per
key, so now and then these numbers are written out with the list of exports they
cover; a run reads the last such state and only the exports that came after it.
The exports stay the truth: a state that is missing or broken off costs a longer read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.frames import empty_frame
from partflow.operators.versioned import max_versions
from partflow.sources.storage import Storage

#: How many exports a run reads beside the state before it writes the next one.
COMPACT_AFTER = 16

_COVERED = "path string, modified double"


def _states(storage: Storage, out: str, dataset: str) -> list[str]:
    """Whole states, the last one last. The keys are written after the list of exports."""
    return [path.rsplit("/", 2)[0] for path in storage.matching(f"{out}/_versions/{dataset}/state=*/keys/_SUCCESS")]


def _exports(storage: Storage, out: str, dataset: str) -> dict[str, float | None]:
    """Every export with the time it was finished; None for what is not known to be whole."""
    finished = {path.rsplit("/", 1)[0]: when for path, when in storage.modified(f"{out}/{dataset}/date=*/*/_SUCCESS").items()}
    listed = storage.matching(f"{out}/{dataset}/date=*/*")
    return {path: finished.get(path) for path in listed if path.rsplit("/", 1)[1][0] not in "._"}


def _covered(spark: SparkSession, state: str | None) -> dict[str, float]:
    # as many rows as there are exports, whose directories a read of them lists on the driver as well
    rows = spark.read.schema(_COVERED).parquet(f"{state}/exports") if state else None
    return {row.path: row.modified for row in rows.toLocalIterator()} if rows is not None else {}


def _parts(spark: SparkSession, out: str, dataset: str) -> tuple[str | None, dict[str, float | None], list[str]]:
    """The last state, all exports, and those that it does not cover as they are now."""
    storage = Storage(spark)
    exports = _exports(storage, out, dataset)
    state = (_states(storage, out, dataset) or [None])[-1]
    covered = _covered(spark, state)
    # a covered export that was taken back or written anew may have held the highest version of a key
    if any(exports.get(path) != when for path, when in covered.items()):
        state, covered = None, {}
    return state, exports, [path for path in exports if path not in covered]


def _highest(spark: SparkSession, key: T.StructField, state: str | None, later: list[str]) -> DataFrame:
    fields = T.StructType([T.StructField(key.name, key.dataType), T.StructField("version", T.IntegerType())])
    rows = empty_frame(spark, fields)
    if later:
        rows = spark.read.schema(fields).option("recursiveFileLookup", True).parquet(*later)
    if state is not None:
        kept = T.StructType([fields[0], T.StructField("max_version", T.IntegerType())])
        rows = rows.unionAll(spark.read.schema(kept).parquet(f"{state}/keys"))
    return max_versions(rows, key.name)


def highest_versions(spark: SparkSession, out: str, dataset: str, key: T.StructField) -> DataFrame:
    """``key, max_version`` over every export of a dataset, one row per key."""
    state, _, later = _parts(spark, out, dataset)
    return _highest(spark, key, state, later)


def compact_versions(spark: SparkSession, out: str, dataset: str, key: T.StructField, after: int = COMPACT_AFTER) -> bool:
    """Write the next state if ``after`` or more exports lie beside the last one; returns whether it did.

    An export counts as covered with the time it was finished; one that is taken back or
    written anew makes the state void, and all are read again. Exports not known to be whole
    are never covered. The state before the new one stays for runs that read it; older
    ones go. Two writers at once write two states, each right by itself.
    """
    state, exports, later = _parts(spark, out, dataset)
    whole = [path for path in later if exports[path] is not None]
    if not whole or len(whole) < after:
        return False
    storage = Storage(spark)
    folder = f"{out}/_versions/{dataset}"
    last = [int(path.rsplit("=", 1)[1].split("-")[0]) for path in storage.matching(f"{folder}/state=*")]
    new = f"{folder}/state={max(last, default=0) + 1:06d}-{uuid.uuid4().hex}"
    unread = set(later) - set(whole)
    covered = [(path, when) for path, when in exports.items() if path not in unread]
    spark.createDataFrame(covered, _COVERED).coalesce(1).write.parquet(f"{new}/exports")
    _highest(spark, key, state, whole).hint("rebalance").write.parquet(f"{new}/keys")
    for old in _states(storage, out, dataset)[:-2]:
        storage.delete(old)
    return True
