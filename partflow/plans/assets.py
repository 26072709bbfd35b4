"""Snapshots of asset data, several a day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import one_row
from partflow.operators.assets import clean_assets
from partflow.operators.selection import COMPLETED
from partflow.scratch import materialise
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import publish_day_snapshot
from partflow.sources.inventory import list_objects
from partflow.spec import LEDGER_SCHEMAS

ASSET_DATA = "asset_data"


def export_snapshot(
    spark: SparkSession, assets: DataFrame, target: str, ledger: Ledger, now: dt.datetime, dataset: str = ASSET_DATA
) -> str | None:
    """Clean the landed assets and write them as the next snapshot of the day; returns its value ``day.N``.

    The number is claimed in the ledger first, under the time of the snapshot: a run that
    is repeated writes the same snapshot again, and runs at the same time write different
    ones. The upload is recorded once as many rows are read back as were to be written.
    Nothing is claimed or written for an empty table.
    """
    run = ledger.start_run(dataset, now)
    with ledger.closing(run, now):
        ready = materialise(clean_assets(assets).withColumn("fetched_at", F.lit(now)), dataset)
        expected = ready.count()
        if not expected:
            ledger.complete_run(run, now, 0, 0)
            return None
        day = now.date().isoformat()
        number = ledger.claim_suffix(dataset, day, now.isoformat())
        value = publish_day_snapshot(ready, target, dataset, day, number)
        key = f"{dataset}/{day}/{dataset}-{value}.parquet"
        arrived = spark.read.schema(ready.schema).parquet(f"{target}/{key}").count()
        if arrived != expected:
            raise OSError(f"{key} holds {arrived} of {expected} rows")
        size = list_objects(spark, f"{target}/{key}", "*.parquet").agg(F.sum("size")).first()[0]
        record = {
            "exporter": dataset,
            "partition_value": value,
            "s3_key": key,
            "file_name": key.rsplit("/", 1)[1],
            "row_count": arrived,
            "file_size": size,
            "uploaded_at": now,
            "status": COMPLETED,
            "event_seq": run.run_id,
        }
        ledger.append("uploads", one_row(spark, LEDGER_SCHEMAS["uploads"], record))
        ledger.complete_run(run, now, expected, arrived)
    return value
