"""Reads of partitioned parquet: one partition, many with their origin, snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.frames import empty_frame
from partflow.functions.keys import DAY_SHAPE, EPOCH_SHAPE
from partflow.scratch import new_dir
from partflow.session import side_session
from partflow.sources.inventory import inventory
from partflow.sources.probe import is_file_fault
from partflow.sources.storage import exists, matching
from partflow.spec import DAILY, DatasetSpec


def read_partition(spark: SparkSession, path: str) -> DataFrame:
    """One partition, its columns exactly as in the file: no column from the path."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def read_partitions(
    spark: SparkSession,
    base: str,
    spec: DatasetSpec,
    values: Iterable[str] | None = None,
    schema: T.StructType | None = None,
    tolerant: bool = False,
    listed: DataFrame | None = None,
) -> DataFrame:
    """All partitions of a dataset with ``partition_value`` (text) from the path.

    ``values`` become partition filters, so other directories are not opened. A
    file column named like the directory key gives way to the path's value.
    Where a partition holds its canonical file, other files beside it are left
    out. With a ``schema`` a missing dataset is an empty frame, and a ``tolerant``
    read leaves unreadable files out instead of failing. ``listed`` is the
    inventory where the caller has it already.
    """
    root = f"{base}/{spec.name}"
    key = spec.partition_column
    directories = f"{root}/{key}=*"
    if not matching(spark, directories):
        if schema is None:
            raise FileNotFoundError(directories)
        empty = T.StructType([*schema.fields, T.StructField("partition_value", T.StringType())])
        return empty_frame(spark, empty)
    found = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
    fields = schema if schema is not None else _schema(found, directories)
    with_key = T.StructType([f for f in fields.fields if f.name != key]).add(key, T.StringType())
    rows = (
        found.schema(with_key)
        .option("ignoreCorruptFiles", tolerant)
        .parquet(directories)
        .where(F.col(key).rlike(f"^({DAY_SHAPE if spec.partition_type == DAILY else EPOCH_SHAPE})$"))
    )
    if values is not None:
        rows = rows.where(F.col(key).isin(sorted(set(values))))
    # usually no partition mixes its canonical file with others; a filter on the
    # few that do keeps the rows out of a join on their partition, which may be hot
    listing = inventory(spark, base, spec) if listed is None else listed
    mixed = listing.where(F.col("is_canonical") & (F.col("file_count") > 1)).select("partition_value", "file_path")
    canonical = {row.partition_value: row.file_path.rsplit("/", 1)[1] for row in mixed.toLocalIterator()}
    if canonical:
        is_mixed = F.col(key).isin(sorted(canonical))
        rows = rows.where(~is_mixed | F.col("_metadata.file_name").isin(sorted(canonical.values())))
    return rows.withColumnRenamed(key, "partition_value")


def _schema(reader, directories: str) -> T.StructType:
    """Schema of a dataset by its first file, or where that is broken by those that aren't."""
    try:
        return reader.parquet(directories).schema
    except (PySparkException, Py4JError) as error:
        if not is_file_fault(error):
            raise
        return reader.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(directories).schema


def file_stats(rows: DataFrame, slot: str | None = None) -> DataFrame:
    """Per file that can be read: ``path``, ``partition_value``, ``row_count`` by its footer, ``rows_read``, slot range.

    ``rows`` is a tolerant read; where pages break off, fewer rows are read than counted.
    """
    path = F.col("_metadata.file_path").alias("path")
    counted = rows.select(path, "partition_value").groupBy("path", "partition_value").agg(F.count(F.lit(1)).alias("row_count"))
    if slot is None:
        return counted.withColumn("rows_read", F.col("row_count"))
    ranges = rows.select(path, F.col(slot).alias("slot")).groupBy("path").agg(
        F.count(F.lit(1)).alias("rows_read"), F.min("slot").alias("min_slot"), F.max("slot").alias("max_slot")
    )
    return counted.join(ranges, "path", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))


def footer_stats(
    spark: SparkSession, base: str, spec: DatasetSpec, values: Iterable[str], slot: str | None = None
) -> DataFrame:
    """Statistics per partition from the footers of its files; no page is read.

    Equal to ``partition_stats`` over the partitions' rows where every file
    counts, which a file without statistics for the slot makes impossible: that
    raises, and the caller has to scan. The result is written out.
    """
    root, key = f"{base}/{spec.name}", spec.partition_column
    settings = {
        "spark.sql.sources.useV1SourceList": "",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }
    rows = (
        side_session(spark, **settings)
        .read.option("basePath", root)
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{root}/{key}=*")
    )
    measures = [F.count(F.lit(1)).alias("row_count")]
    if slot is not None:
        measures += [F.min(slot).alias("min_slot"), F.max(slot).alias("max_slot")]
    stats = rows.where(F.col(key).isin(sorted(set(values)))).groupBy(key).agg(*measures)
    stats = stats.withColumnRenamed(key, "partition_value")
    path = new_dir(spark, "footer-stats")
    stats.write.parquet(path)
    return spark.read.schema(stats.schema).parquet(path)


def read_with_source(
    spark: SparkSession,
    base: str,
    spec: DatasetSpec,
    schema: T.StructType,
    dates: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of a daily dataset with ``source_date``: all of them, or of some dates."""
    rows = read_partitions(spark, base, spec, dates, schema)
    return rows.select(*[f.name for f in schema.fields], F.col("partition_value").alias("source_date"))


def read_exports(spark: SparkSession, base: str, dataset: str, schema: T.StructType) -> DataFrame:
    """Every earlier export of a dataset with its ``date``; empty when there is none."""
    with_date = T.StructType([*schema.fields, T.StructField("date", T.StringType())])
    root = f"{base}/{dataset}"
    if not exists(spark, root):
        return empty_frame(spark, with_date)
    return spark.read.schema(with_date).parquet(root)


#: Where pointers to snapshots lie: a directory for each number, in it a file named by the snapshot.
POINTERS = "_current"


def pointers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and snapshot's directory name of every pointer below ``root``, the current one last."""
    found = (path.rsplit("/", 2)[1:] for path in matching(spark, f"{root}/{POINTERS}/*/by-*"))
    return sorted((int(number), name.removeprefix("by-")) for number, name in found)


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Directory of the snapshot that the last pointer below ``root`` names.

    Pointers to what has no whole snapshot are passed over; without any pointer it
    is the whole snapshot with the greatest label.
    """
    committed = {p.rsplit("/", 2)[1]: p.rsplit("/", 1)[0] for p in matching(spark, f"{root}/snapshot=*/_SUCCESS")}
    named = [name for _, name in pointers(spark, root) if name in committed]
    return committed[named[-1] if named else max(committed)] if committed else None


def read_snapshot(
    spark: SparkSession, root: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """The newest snapshot, or some of its columns; empty when there is none."""
    wanted = T.StructType([f for f in schema.fields if columns is None or f.name in columns])
    path = latest_snapshot(spark, root)
    if path is None:
        return empty_frame(spark, wanted)
    return spark.read.schema(wanted).option("recursiveFileLookup", True).parquet(path)
