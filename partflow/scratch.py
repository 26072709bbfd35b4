"""Shared working storage for intermediate tables.

A cluster names a folder every executor can reach in ``spark.checkpoint.dir``;
everything a job writes in passing goes below it, so a lost executor never takes
an intermediate result with it. Only a local session without that setting falls
back to a temporary folder of the machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="partflow-")
    spark.conf.set(_SETTING, folder)
    return folder


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses (not created yet)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back with its schema.

    For a frame that several later jobs use: the work runs once, the lineage is
    cut, and the result survives the loss of any executor.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
