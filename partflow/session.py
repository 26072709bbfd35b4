"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that matter for plans. Shuffle partitions are left to AQE, which
#: coalesces small ones and splits skewed ones; the advisory size is also the
#: target size of the files behind a ``rebalance`` hint.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def side_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark``, on the same executors, that reads with other settings.

    What it computes has to be written out: frames of two sessions do not mix.
    """
    beside = spark.newSession()
    for key, value in settings.items():
        beside.conf.set(key, value)
    return beside


def build_session(app_name: str = "partflow", master: str | None = None, **extra: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``extra`` adds or overrides settings by name."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
