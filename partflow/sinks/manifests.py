"""Manifests as JSON: totals, one line per exporter, one line per object, or all of it as one document."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators import catalog
from partflow.scratch import materialise
from partflow.spec import MANIFEST_SCHEMA, MANIFEST_SUMMARY_SCHEMA


def write_manifest(objects: DataFrame, target: str, generated_at: dt.datetime) -> None:
    """Write ``totals``, ``exporters`` and ``partitions`` below ``target``.

    The listing is written by many tasks, range-partitioned by exporter,
    partition and key, so its files read in order and no exporter, however
    large, is gathered anywhere.
    """
    entries = materialise(catalog.manifest_entries(objects), "manifest-entries")
    summary = catalog.manifest_summary(entries)
    stamp = F.lit(generated_at.isoformat()).alias("generated_at")
    catalog.manifest_totals(summary).select(stamp, "*").coalesce(1).write.mode("overwrite").json(f"{target}/totals")
    summary.orderBy("exporter").write.mode("overwrite").json(f"{target}/exporters")
    entries.orderBy("exporter", "partition_value", "s3_key").write.mode("overwrite").json(f"{target}/partitions")


def _json(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _opened(*columns: str | Column, array: str) -> Column:
    """A JSON object left open within its last member, an array."""
    whole = _json(*columns)
    return F.concat(F.substr(whole, F.lit(1), F.length(whole) - 1), F.lit(f',"{array}":['))


def write_manifest_document(objects: DataFrame, target: str, generated_at: dt.datetime) -> None:
    """Write the manifest as one JSON document in parts: the files below ``target``, by name one after the other.

    The document holds time and totals, then every exporter with its summary and its
    partitions. Its lines are rows like any others, range-sorted into the parts, so
    neither a task nor the driver holds the document or an exporter's share of it; what
    wants it as one object joins the parts (``cat``, or a store's multipart copy). Only an exporter's first
    entry has no comma before it; of entries that are all the same one is the first.
    """
    entries = materialise(
        catalog.manifest_entries(objects).withColumn("line_id", F.monotonically_increasing_id()), "manifest-lines"
    )
    place = F.struct("partition_value", "s3_key", "line_id")
    summary = catalog.manifest_summary(entries)
    heads = entries.groupBy("exporter").agg(F.min(place).alias("head"))
    # at most one row, and one of that name
    first_exporter = heads.agg(F.min("exporter").alias("exporter")).withColumn("is_first", F.lit(True))

    def lines(rows: DataFrame, section: int, kind: int, text: Column, place: Column | None = None) -> DataFrame:
        exporter = F.col("exporter") if section == 1 else F.lit(None).cast("string")
        none = F.lit(None).cast("struct<partition_value: string, s3_key: string, line_id: bigint>")
        return rows.select(
            F.lit(section).alias("section"), exporter.alias("exporter"), F.lit(kind).alias("kind"),
            (none if place is None else place).alias("place"), text.alias("line"),
        )

    comma = lambda first: F.when(first, "").otherwise(",")
    totals = catalog.manifest_totals(summary)
    stamp = F.lit(generated_at.isoformat()).alias("generated_at")
    opened = _opened(*[c for c in summary.columns], array="partitions")
    own = [F.col(f.name) for f in MANIFEST_SCHEMA.fields]
    parts = [
        lines(totals, 0, 0, _opened(stamp, *totals.columns, array="by_exporter")),
        lines(summary.join(first_exporter, "exporter", "left"), 1, 0, F.concat(comma(F.col("is_first").isNotNull()), opened)),
        lines(entries.join(heads, "exporter"), 1, 1, F.concat(comma(place == F.col("head")), _json(*own)), place),
        lines(summary, 1, 2, F.lit("]}")),
        lines(totals, 2, 0, F.lit("]}")),
    ]
    document = parts[0]
    for part in parts[1:]:
        document = document.unionAll(part)
    document.orderBy("section", "exporter", "kind", "place").select("line").write.mode("overwrite").text(target)


def read_manifest_document(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """The exporters' summaries and the partitions' entries of a document that :func:`write_manifest_document` wrote.

    Lines are read each by itself, wherever files are cut.
    """
    line = F.ltrim(F.col("value"), F.lit(","))
    rows = spark.read.text(target).select(line.alias("line"))
    tail = '"partitions":['
    opened = rows.where(F.col("line").endswith(tail)).select(F.concat("line", F.lit("]}")).alias("line"))
    entries = rows.where(F.col("line").startswith("{") & F.col("line").endswith("}"))
    return _parsed(opened, MANIFEST_SUMMARY_SCHEMA), _parsed(entries, MANIFEST_SCHEMA)


def _parsed(rows: DataFrame, schema) -> DataFrame:
    return rows.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("read")).select("read.*")


def write_file_index(objects: DataFrame, target: str, generated_at: dt.datetime) -> None:
    """Write ``totals`` (version, time, number of files), ``exporters`` and ``files``."""
    index = materialise(catalog.file_index(objects), "file-index")
    totals = index.agg(F.count(F.lit(1)).alias("total_files")).select(
        F.lit("1.0").alias("version"), F.lit(generated_at.isoformat()).alias("generated_at"), "total_files"
    )
    totals.coalesce(1).write.mode("overwrite").json(f"{target}/totals")
    catalog.file_counts(index).orderBy("exporter").write.mode("overwrite").json(f"{target}/exporters")
    index.orderBy("exporter", "file").write.mode("overwrite").json(f"{target}/files")
