"""Which partitions and objects exist, as DataFrames. File contents are never read."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame
from partflow.functions.keys import DAY_SHAPE, EPOCH_SHAPE, file_name
from partflow.scratch import new_dir
from partflow.session import side_session
from partflow.sources.storage import exists, qualified
from partflow.spec import DAILY, DatasetSpec, flat_schema

INVENTORY_SCHEMA = flat_schema(
    "exporter string, partition_value string, partition_type string, file_path string,"
    " file_size bigint, file_count bigint, is_canonical boolean"
)
_LISTING_SCHEMA = flat_schema("path string, length bigint, modificationTime timestamp")
OBJECT_SCHEMA = flat_schema("key string, size bigint, last_modified timestamp")


def _listing(spark: SparkSession, root: str, pattern: str, folders: Sequence[str] | None = None) -> DataFrame:
    """Path, length and time of change of the files below ``root``, or of those of its ``folders`` that are there.

    A scan plans its tasks by the size of the files even if it opens none, so the
    listing is made under a split size that gives each core one task, and kept.
    """
    path = new_dir(spark, "listing")
    present = [root] if folders is None else [folder for folder in folders if exists(spark, folder)]
    if not present:
        return empty_frame(spark, _LISTING_SCHEMA)
    files = (
        side_session(spark, **{"spark.sql.files.maxPartitionBytes": "1t"})
        .read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(present)
        .select("path", "length", "modificationTime")
    )
    files.write.parquet(path)
    return spark.read.schema(files.schema).parquet(path)


def inventory(spark: SparkSession, base: str, spec: DatasetSpec, values: Iterable[str] | None = None) -> DataFrame:
    """One row per partition directory of a dataset that holds parquet files; with ``values`` only theirs are listed.

    Directories of another shape do not count. Where the canonically named file
    is present the partition is that file; otherwise it is the whole directory,
    as Spark writes several files per partition, with their sizes summed.
    """
    root = f"{base}/{spec.name}"
    if not exists(spark, root):
        return empty_frame(spark, INVENTORY_SCHEMA)
    shape = DAY_SHAPE if spec.partition_type == DAILY else EPOCH_SHAPE
    directory = f"/{spec.partition_column}=({shape})/[^/]+$"
    parent = F.regexp_replace("path", "/[^/]+$", "")
    value = F.regexp_extract("path", directory, 1)
    name = F.substring_index("path", "/", -1)
    below_root = F.substring_index(parent, "/", -2) == F.concat(
        F.lit(f"{spec.name}/{spec.partition_column}="), value
    )
    canonical = name == file_name(F.lit(spec.name), F.col("partition_value"), F.lit(spec.partition_type))
    whole = F.struct(F.col("path").alias("path"), F.col("length").alias("length"))
    return (
        _listing(spark, root, "*.parquet", None if values is None else [f"{root}/{spec.partition_column}={v}" for v in values])
        .withColumn("partition_value", value)
        .where((F.col("partition_value") != "") & below_root)
        .withColumn("_canonical", F.when(canonical, whole))
        .groupBy("partition_value", parent.alias("_parent"))
        .agg(
            F.max("_canonical").alias("_canonical"),
            F.sum("length").alias("_size"),
            F.count(F.lit(1)).alias("file_count"),
        )
        .select(
            F.lit(spec.name).alias("exporter"),
            "partition_value",
            F.lit(spec.partition_type).alias("partition_type"),
            F.coalesce("_canonical.path", "_parent").alias("file_path"),
            F.coalesce("_canonical.length", "_size").alias("file_size"),
            "file_count",
            F.col("_canonical").isNotNull().alias("is_canonical"),
        )
    )


def inventory_files(spark: SparkSession, base: str, listed: DataFrame) -> DataFrame:
    """The files that make up the partitions in ``listed`` (rows of :func:`inventory`): ``path``, ``partition_value``.

    A partition that is its canonical file has that one, any other all of its directory.
    """
    name = listed.select("exporter").first()
    if name is None:
        return listed.select(F.col("file_path").alias("path"), "partition_value")
    # directories, as many as the read of the partitions has
    folders = [row.file_path for row in listed.where("NOT is_canonical").select("file_path").toLocalIterator()]
    files = _listing(spark, f"{base}/{name.exporter}", "*.parquet", folders).select("path")
    whole = listed.where("is_canonical").select(F.col("file_path").alias("path"), "partition_value")
    parents = listed.where("NOT is_canonical").select(F.col("file_path").alias("_parent"), "partition_value")
    inside = files.withColumn("_parent", F.regexp_replace("path", "/[^/]+$", "")).join(parents, "_parent")
    return whole.unionByName(inside.select("path", "partition_value"))


def list_objects(spark: SparkSession, root: str, pattern: str = "*", folders: Sequence[str] | None = None) -> DataFrame:
    """Every object below ``root``, or below some folders of it: key relative to it, size, time of change."""
    if not exists(spark, root):
        return empty_frame(spark, OBJECT_SCHEMA)
    prefix = qualified(spark, root).rstrip("/") + "/"
    return _listing(spark, root, pattern, folders).select(
        F.expr(f"substring(path, {len(prefix) + 1})").alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
