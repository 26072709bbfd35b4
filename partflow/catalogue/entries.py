"""The list of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.functions.keys import day_text


class Tables:
    """The given parquet tables, read on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Entry:
    """One query: what Spark runs and, where there is one, the SQL with the same result."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Entry] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def add(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        CATALOGUE[name] = Entry(name, lambda spark, folder: function(Tables(spark, folder)), sql)
        return function

    return add


def day() -> Column:
    """Day of an event as text, the partition value of most stand-ins."""
    return day_text(F.col("ts"))


def midnight(text: str) -> Column:
    """Start of a day; compared with ``ts`` it reaches the scan."""
    return F.lit(f"{text} 00:00:00").cast("timestamp_ntz")


def event_partitions(t: Tables) -> DataFrame:
    """Events as ledger events: exporter = type, partition = day, sequence = event id."""
    return t.events.select(
        F.col("event_type").alias("exporter"),
        day().alias("partition_value"),
        F.col("event_id").alias("event_seq"),
        "value",
        "user_id",
    )
