import pytest
from pyspark.sql import functions as F

from partflow.functions import keys
from partflow.functions.text import has_text, joined_messages, strip, whole_number
from partflow.operators.selection import keep_pending, keep_requested, requested_values
from partflow.spec import STANDARD_DATASETS, DatasetSpec, select_datasets

from helpers import rows


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_object_keys(spark):
    lit = F.lit
    assert one(spark, keys.object_key(lit("block"), lit("2024-01-15"), lit("daily"))) == (
        "block/2024-01-15/block-2024-01-15.parquet"
    )
    assert one(spark, keys.object_key(lit("reward"), lit("500"), lit("epoch"))) == "reward/500/reward-epoch-500.parquet"


@pytest.mark.parametrize(
    "key, expected",
    [
        ("block/2024-01-15/block-2024-01-15.parquet", ("block", "2024-01-15", "block-2024-01-15.parquet")),
        ("reward/500/reward-epoch-500.parquet", ("reward", "500", "reward-epoch-500.parquet")),
        ("a/2024-01-15/a-2024-01-15.3.parquet", ("a", "2024-01-15", "a-2024-01-15.3.parquet")),
        ("a/7/deep/er.parquet", ("a", "7", "deep/er.parquet")),
        ("a/2024-1-15/f.parquet", None),
        ("a/date=2024-01-15/f.parquet", None),
        ("a/7/f.csv", None),
        ("a/7/.parquet", None),
        ("manifest.json", None),
        ("x/a/7/f.parquet", None),
    ],
)
def test_parse_key(spark, key, expected):
    found = one(spark, keys.parse_key(F.lit(key)))
    assert (tuple(found) if found else None) == expected


def test_migrate_key_and_types(spark):
    assert one(spark, keys.migrate_key(F.lit("a/date=2024-01-15/f.parquet"))) == "a/2024-01-15/f.parquet"
    assert one(spark, keys.migrate_key(F.lit("a/epoch=12/f.parquet"))) == "a/12/f.parquet"
    assert one(spark, keys.migrate_key(F.lit("a/12/f.parquet"))) == "a/12/f.parquet"
    assert one(spark, keys.partition_type_of(F.lit("2024-01-15"))) == "daily"
    assert one(spark, keys.partition_type_of(F.lit("12"))) == "epoch"
    assert one(spark, keys.partition_type_of(F.lit("2024-01-15.1"))) is None
    assert one(spark, keys.source_date(F.lit("/x/date=2024-01-15/f"))) == "2024-01-15"


def test_ranges(spark):
    days = keys.parse_range("2024-02-27:2024-03-01").frame(spark)
    assert [r[0] for r in rows(days)] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert [r[0] for r in rows(keys.parse_range("9:11").frame(spark))] == ["10", "11", "9"]
    assert [r[0] for r in rows(keys.parse_range("500:500").frame(spark))] == ["500"]
    for bad in ("5", "7:5", "2024-01-02:2024-01-01", "a:b", "2024-01-01:5", "2024-13-01:2024-13-02"):
        with pytest.raises(ValueError):
            keys.parse_range(bad)


def test_range_values_of_a_column(spark):
    assert one(spark, keys.range_values(F.lit("3:5"))) == ["3", "4", "5"]
    assert one(spark, keys.range_values(F.lit("2024-01-31:2024-02-01"))) == ["2024-01-31", "2024-02-01"]
    for bad in ("5:3", "x", "2024-01-01:4", "2024-02-30:2024-03-01"):
        assert one(spark, keys.range_values(F.lit(bad))) is None


def test_day_of_epoch_seconds_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = one(spark, keys.day_of_epoch_seconds(F.lit(1705276799)).cast("string"))
        assert got == "2024-01-14"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_text(spark):
    texts = [("a",), (" ",), ("\t\n",), ("  ",), ("\x1c",), ("",), (None,), (" x  ",)]
    df = spark.createDataFrame(texts, "v string").select(has_text(F.col("v")).alias("h"), strip(F.col("v")).alias("s"))
    got = df.collect()
    assert [r.h for r in got] == [True, False, False, False, False, False, False, True]
    assert got[-1].s == "x"
    assert one(spark, joined_messages(F.lit(None).cast("string"), F.lit(None).cast("string"))) is None
    assert one(spark, joined_messages(F.lit("a"), F.lit("b"))) == "a; b"


def test_whole_number(spark):
    texts = ["7", "-12", "+5", "9223372036854775807", "9223372036854775808", "1" * 20, "", "x", "1.5", "2024-01-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(whole_number(F.col("v")).alias("n"))
    assert [r.n for r in df.collect()] == [7, -12, 5, 2**63 - 1] + [None] * 7


def test_select_datasets():
    assert len(STANDARD_DATASETS) == 13
    found, unknown = select_datasets(STANDARD_DATASETS, ["reward", "nope"])
    assert [s.name for s in found] == ["reward"] and unknown == ["nope"]
    assert found[0].partition_column == "epoch" and found[0].slot_column == "earned_epoch"
    assert len(select_datasets(STANDARD_DATASETS, group="dune")[0]) == 13
    assert select_datasets(STANDARD_DATASETS, group="other")[0] == []
    with pytest.raises(ValueError):
        DatasetSpec("x", "x", "slot", "hourly")


def test_requested_and_pending(spark):
    inventory = spark.createDataFrame(
        [("block", v) for v in ("2024-01-01", "2024-01-02", "2024-01-05")], "exporter string, partition_value string"
    )
    wanted = requested_values(spark, ["2024-01-05", "2023-12-25"], keys.parse_range("2024-01-01:2024-01-01"))
    assert [r[0] for r in rows(keep_requested(inventory, wanted), "partition_value")] == ["2024-01-01", "2024-01-05"]
    assert requested_values(spark) is None
    assert keep_requested(inventory, None).count() == 3
    uploads = spark.createDataFrame(
        [("block", "2024-01-01", "completed"), ("block", "2024-01-02", "failed"), ("other", "2024-01-05", "completed")],
        "exporter string, partition_value string, status string",
    )
    assert [r[0] for r in rows(keep_pending(inventory, uploads), "partition_value")] == ["2024-01-02", "2024-01-05"]
