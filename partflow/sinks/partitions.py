"""Publishing partitions, and checking that they arrived."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.operators.stats import partition_stats
from partflow.sources.inventory import list_objects
from partflow.sources.storage import Move, Moved, Retry, Storage
from partflow.spec import EPOCH, DatasetSpec

BARE = "bare"
HIVE = "hive"
_VALUE = "partition_value"


def partition_directory(target: str, spec: DatasetSpec, value: str, layout: str = BARE) -> str:
    """Directory of a published partition: the value alone, or ``column=value``."""
    name = value if layout == BARE else f"{spec.partition_column}={value}"
    return f"{target}/{spec.name}/{name}"


def stage_partitions(rows: DataFrame, target: str, arranged: bool = False) -> str:
    """Write ``rows`` (with ``partition_value``) to a new staging directory below ``target``.

    One job writes everything. ``rebalance`` makes files of the advisory size,
    splitting a huge partition over many tasks and packing small ones; rows read
    from partitioned files are ``arranged`` already and are written where they are
    read, without a shuffle.
    """
    staging = f"{target}/_staging-{uuid.uuid4().hex}"
    (rows if arranged else rows.hint("rebalance", _VALUE)).write.partitionBy(_VALUE).parquet(staging)
    return staging


def stays_in_place(rows: DataFrame) -> bool:
    """Whether rows read from partitioned files are still where they were read: no step shuffles them."""
    return not re.search(r"(?<!Broadcast)Exchange ", rows._jdf.queryExecution().executedPlan().toString())


def staged_stats(like: DataFrame, staging: str, slot: Column | None = None) -> DataFrame:
    """Statistics of the partitions in a staging directory, read back from it."""
    spark = like.sparkSession
    schema = type(like.schema)([f for f in like.schema.fields if f.name != _VALUE]).add(_VALUE, "string")
    if not Storage(spark).matching(f"{staging}/{_VALUE}=*"):
        return partition_stats(empty_frame(spark, schema), F.col(_VALUE), slot)
    return partition_stats(spark.read.schema(schema).parquet(staging), F.col(_VALUE), slot)


def move_staged(
    storage: Storage,
    staging: str,
    target: str,
    spec: DatasetSpec,
    layout: str = BARE,
    only: set[str] | None = None,
    retry: Retry | None = None,
) -> dict[str, Moved]:
    """Put staged partitions (all, or ``only`` some) in the place of the published ones, and remove the rest.

    Readers see the old or the new partition, or for the moment between two
    renames none. Returns how each partition's move went; one that failed stops no
    other.
    """
    storage.restore(f"{target}/{spec.name}")
    between = "-epoch-" if spec.partition_type == EPOCH else "-"
    staged = {path.rsplit("=", 1)[1]: path for path in storage.matching(f"{staging}/{_VALUE}=*")}
    moves = {
        # a partition that is one file has the name partitions have
        value: Move(path, partition_directory(target, spec, value, layout), f"{spec.name}{between}{value}.parquet")
        for value, path in staged.items()
        if only is None or value in only
    }
    moved = dict(zip(moves, storage.replace_directories(moves.values(), retry)))
    storage.delete(staging)
    return moved


def publish_partitions(
    rows: DataFrame, target: str, spec: DatasetSpec, layout: str = BARE, arranged: bool = False
) -> list[str]:
    """Write ``rows`` (with ``partition_value``), replacing the partitions they belong to.

    Publishing the same rows again changes nothing. Returns the values published; if
    one of them could not be, all others are and an error is raised.
    """
    staging = stage_partitions(rows, target, arranged)
    moved = move_staged(Storage(rows.sparkSession), staging, target, spec, layout)
    for one in moved.values():
        if one.error is not None:
            raise OSError(one.error)
    return list(moved)


def published_objects(
    spark: SparkSession, target: str, spec: DatasetSpec, values: Iterable[str] | None = None, layout: str = BARE
) -> DataFrame:
    """Objects of the published partitions as they are: ``partition_value, s3_key, file_size, file_count``.

    The key is that of a partition's only file, else its directory's. With ``values``
    only their directories are listed.
    """
    folders = None if values is None else [partition_directory(target, spec, value, layout) for value in values]
    objects = list_objects(spark, f"{target}/{spec.name}", "*.parquet", folders)
    directory = F.regexp_replace("key", "/[^/]+$", "")
    found = objects.groupBy(directory.alias("_directory")).agg(
        F.min("key").alias("_key"), F.sum("size").alias("file_size"), F.count(F.lit(1)).alias("file_count")
    )
    key = F.when(F.col("file_count") == 1, F.col("_key")).otherwise(F.col("_directory"))
    return found.select(
        F.regexp_replace("_directory", "^[^=]*=", "").alias("partition_value"),
        F.concat(F.lit(f"{spec.name}/"), key).alias("s3_key"),
        "file_size",
        "file_count",
    )


def publish_day_snapshot(rows: DataFrame, target: str, dataset: str, day: str, suffix: int) -> str:
    """Write one of several snapshots of a day; returns its partition value ``day.N``."""
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{target}/{dataset}/{day}/{dataset}-{day}.{suffix}.parquet")
    return f"{day}.{suffix}"


def published_stats(
    like: DataFrame,
    target: str,
    spec: DatasetSpec,
    values: Sequence[str],
    slot: Column | None = None,
    layout: str = BARE,
) -> DataFrame:
    """Statistics of published partitions, read back from the target."""
    spark = like.sparkSession
    wanted = [partition_directory(target, spec, v, layout) for v in values]
    storage = Storage(spark)
    present = set(storage.matching(f"{target}/{spec.name}/*"))
    paths = [path for path in map(storage.qualified, wanted) if path in present]
    fields = [f for f in like.schema.fields if f.name != _VALUE]
    schema = type(like.schema)(fields)
    if not paths:
        empty = empty_frame(spark, schema)
        return partition_stats(empty, F.lit("").cast("string"), slot)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
    directory = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return partition_stats(rows, F.regexp_replace(directory, "^[^=]*=", ""), slot)


def verify_published(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Both statistics side by side per partition, with ``is_published``.

    Files are encoded anew, so rows and slots are compared rather than bytes. A
    partition missing on either side is not published.
    """
    measures = [name for name in ("row_count", "min_slot", "max_slot") if name in found.columns]
    actual = found.select(_VALUE, *[F.col(name).alias(f"found_{name}") for name in measures])
    same = F.lit(True)
    for name in measures:
        same = same & F.col(name).eqNullSafe(F.col(f"found_{name}"))
    return expected.join(actual, _VALUE, "full_outer").withColumn("is_published", same)
