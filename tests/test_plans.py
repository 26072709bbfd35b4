"""What the physical plans must look like, and how they take a hot key."""

import pytest
from pyspark.sql import functions as F

from partflow.catalogue import CATALOGUE
from partflow.operators import enrich, keyed, rangecount
from partflow.operators.stats import partition_stats

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [name for name, e in CATALOGUE.items() if not e.run.__closure__[0].cell_contents.__module__.endswith("jobs")]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(CATALOGUE[name].run(spark, DATA))
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list(struct(event"):
        assert word not in text


def test_statistics_read_two_columns_and_combine_before_the_shuffle(spark):
    text = plan(CATALOGUE["partition_stats_daily"].run(spark, DATA))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    assert "partial_count(1)" in text and text.count("Exchange") == 1


def test_newest_per_key_combines_before_the_shuffle(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    text = plan(keyed.newest_per_key(events.select("user_id", "event_id", "value"), ["user_id"], ["event_id"]))
    assert "partial_max" in text and text.count("Exchange") == 1 and "Window" not in text


def test_day_filter_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    ranges = spark.createDataFrame([("a", 10, 20)], "id string, lo bigint, hi bigint")
    captured = []
    original = rangecount.materialise
    rangecount.materialise = lambda df, label: captured.append(df) or original(df, label)
    try:
        rangecount.count_in_ranges(orders, F.col("o_orderkey"), ranges, "lo", "hi")
    finally:
        rangecount.materialise = original
    assert "GreaterThanOrEqual(o_orderkey,10), LessThanOrEqual(o_orderkey,20)" in plan(captured[0])


def test_a_hot_key_is_split_when_enriching(spark):
    """A third of the facts share one key; the join splits its partition instead of one task taking it."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
        fact = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        lookup = spark.range(-1, 150_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
        joined = enrich.enrich(fact, lookup, "k", ["name"])
        total = joined.agg(F.count("*").alias("n"), F.count("name").alias("m"), F.max("payload"))
        row = total.collect()[0]
        assert (row.n, row.m) == (300_000, 100_000 + sum(1 for i in range(150_000) if i % 3))
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_huge_partition_is_written_by_many_tasks(spark, tmp_path):
    from partflow.sinks.partitions import publish_partitions
    from partflow.spec import EPOCH, DatasetSpec

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        value = F.when(F.col("id") < 90_000, "1").otherwise((F.col("id") % 5).cast("string"))
        rows = spark.range(0, 100_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("p"), value.alias("partition_value"))
        publish_partitions(rows, str(tmp_path), DatasetSpec("d", "", "id", EPOCH))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = lambda v: len(list((tmp_path / "d" / v).glob("*.parquet")))
    assert files("1") > 5 and files("3") <= 2
    back = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "d"))
    assert back.count() == 100_000 == back.select("id").distinct().count()


def test_statistics_of_nothing(spark):
    assert partition_stats(spark.range(0), F.lit("x"), F.col("id")).count() == 0
