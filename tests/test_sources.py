from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from partflow.operators.stats import partition_stats
from partflow.sinks.snapshots import write_snapshot
from partflow.sources.documents import read_documents, read_responses
from partflow.sources.inventory import inventory, inventory_files, list_objects
from partflow.sources.partitions import (
    file_stats,
    footer_stats,
    latest_snapshot,
    read_partition,
    read_partitions,
    read_snapshot,
    read_with_source,
)
from partflow.sources.probe import EMPTY, UNREADABLE, file_verdicts
from partflow.spec import DAILY, EPOCH, REGISTRATION_SCHEMA, DatasetSpec, flat_schema
from pyspark.sql import functions as F

from helpers import rows, write_partition, write_registrations

BLOCK = DatasetSpec("block", "block", "slot", DAILY)
REWARD = DatasetSpec("reward", "reward", "epoch", EPOCH)
SLOTS = flat_schema("slot bigint, who string")


def test_inventory(spark, tmp_path):
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [1, 2]})
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [9]}, "extra.parquet")
    write_partition(tmp_path, "block", "date=2024-01-16", {"slot": [1]}, "part-0.parquet")
    write_partition(tmp_path, "block", "date=2024-01-16", {"slot": [1]}, "part-1.parquet")
    write_partition(tmp_path, "block", "2024-01-17", {"slot": [1]})
    write_partition(tmp_path, "block", "date=yesterday", {"slot": [1]})
    (tmp_path / "block" / "date=2024-01-18").mkdir()
    found = {r.partition_value: r for r in inventory(spark, str(tmp_path), BLOCK).collect()}
    assert set(found) == {"2024-01-15", "2024-01-16"}
    canonical = found["2024-01-15"]
    assert canonical.is_canonical and canonical.file_path.endswith("block-2024-01-15.parquet")
    assert canonical.file_size == (tmp_path / "block/date=2024-01-15/block-2024-01-15.parquet").stat().st_size
    several = found["2024-01-16"]
    assert several.file_count == 2 and several.file_path.endswith("date=2024-01-16") and not several.is_canonical
    assert several.file_size == sum(p.stat().st_size for p in Path(tmp_path, "block/date=2024-01-16").iterdir())


def test_inventory_of_epochs_and_of_nothing(spark, tmp_path):
    write_partition(tmp_path, "reward", "epoch=500", {"slot": [1]})
    write_partition(tmp_path, "reward", "date=2024-01-01", {"slot": [1]})
    assert rows(inventory(spark, str(tmp_path), REWARD), "partition_value", "partition_type") == [("500", "epoch")]
    assert inventory(spark, str(tmp_path), BLOCK).count() == 0


def test_list_objects(spark, tmp_path):
    path = write_partition(tmp_path, "block", "2024-01-15", {"slot": [1]})
    (tmp_path / "manifest.json").write_text("{}")
    got = {r.key: r.size for r in list_objects(spark, str(tmp_path)).collect()}
    assert got == {"block/2024-01-15/block-2024-01-15.parquet": path.stat().st_size, "manifest.json": 2}


def test_partition_keeps_its_own_columns(spark, tmp_path):
    path = write_partition(tmp_path, "drep_dist", "epoch=500", {"epoch": [499], "amount": [7]})
    assert read_partition(spark, str(path.parent)).collect()[0].asDict() == {"epoch": 499, "amount": 7}


def test_read_partitions_prefers_the_canonical_file_and_prunes(spark, tmp_path):
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [1], "who": ["a"]})
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [9], "who": ["z"]}, "old.parquet")
    write_partition(tmp_path, "block", "date=2024-01-16", {"slot": [2], "who": ["b"]}, "part-0.parquet")
    write_partition(tmp_path, "block", "2024-01-17", {"slot": [3], "who": ["c"]})
    base = str(tmp_path)
    everything = read_partitions(spark, base, BLOCK)
    assert rows(everything, "partition_value", "slot") == [("2024-01-15", 1), ("2024-01-16", 2)]
    some = read_partitions(spark, base, BLOCK, ["2024-01-16", "2024-02-01"])
    assert rows(some, "slot") == [(2,)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_footer_statistics(spark, tmp_path):
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [4, 2]})
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [9]}, "more.parquet")
    write_partition(tmp_path, "block", "date=2024-01-16", {"slot": [7]})
    write_partition(tmp_path, "reward", "epoch=007", {"slot": [7, 7]})
    base, days = str(tmp_path), ["2024-01-15", "2024-02-01"]
    scanned = partition_stats(spark.read.parquet(f"{base}/block/date=2024-01-15"), F.lit("2024-01-15"), F.col("slot"))
    assert rows(footer_stats(spark, base, BLOCK, days, "slot")) == rows(scanned) == [("2024-01-15", 3, 2, 9)]
    assert rows(footer_stats(spark, base, REWARD, ["007"])) == [("007", 2)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_read_with_source(spark, tmp_path):
    base = str(tmp_path)
    spec = DatasetSpec("drep_registration", "", "slot", DAILY)
    assert read_with_source(spark, base, spec, REGISTRATION_SCHEMA).count() == 0
    write_registrations(tmp_path, "2024-01-15", [("d1", None, 5)])
    write_registrations(tmp_path, "2024-01-16", [("d2", None, 6)])
    assert rows(read_with_source(spark, base, spec, REGISTRATION_SCHEMA), "drep_id", "source_date") == [
        ("d1", "2024-01-15"),
        ("d2", "2024-01-16"),
    ]
    assert rows(read_with_source(spark, base, spec, REGISTRATION_SCHEMA, ["2024-01-16"]), "drep_id") == [("d2",)]


def test_unreadable_and_empty_partitions(spark, tmp_path):
    write_partition(tmp_path, "block", "date=2024-01-14", {"slot": [1], "who": ["a"]})
    empty = pa.schema([("slot", pa.int64()), ("who", pa.string())])
    write_partition(tmp_path, "block", "date=2024-01-15", {"slot": [], "who": []}, schema=empty)
    broken = write_partition(tmp_path, "block", "date=2024-01-16", {"slot": [1], "who": ["a"]})
    broken.write_bytes(b"no parquet at all")
    write_partition(tmp_path, "block", "date=2024-01-17", {"slot": [], "who": []}, "part-0.parquet", empty)
    listed = inventory(spark, str(tmp_path), BLOCK)
    readable = read_partitions(spark, str(tmp_path), BLOCK, schema=SLOTS, tolerant=True)
    found = file_stats(readable, "slot").drop("partition_value")
    verdicts = file_verdicts(inventory_files(spark, str(tmp_path), listed), found)
    assert rows(verdicts, "partition_value", "error_details") == [
        ("2024-01-15", EMPTY),
        ("2024-01-16", UNREADABLE),
        ("2024-01-17", EMPTY),
    ]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "profile")
    schema = flat_schema("k string, v bigint")
    assert read_snapshot(spark, root, schema).count() == 0
    first = spark.createDataFrame([("b", 1), ("a", 2)], schema)
    assert write_snapshot(first, root, "0001", "k") == 2
    # the next one is computed from the one it replaces
    longer = read_snapshot(spark, root, schema).withColumn("v", F.col("v") + 1)
    assert write_snapshot(longer, root, "0002", "k") == 2
    assert latest_snapshot(spark, root).endswith("snapshot=0002")
    assert [tuple(r) for r in read_snapshot(spark, root, schema).collect()] == [("a", 3), ("b", 2)]
    assert read_snapshot(spark, root, schema, ["k"]).columns == ["k"]
    assert write_snapshot(longer.where("false"), root, "0003", "k") == 0
    assert latest_snapshot(spark, root).endswith("snapshot=0002")


def test_uncommitted_snapshot_is_ignored(spark, tmp_path):
    root = tmp_path / "p"
    (root / "snapshot=0009").mkdir(parents=True)
    pq.write_table(pa.table({"k": ["x"]}), str(root / "snapshot=0009" / "part-0.parquet"))
    assert latest_snapshot(spark, str(root)) is None


def test_documents(spark, tmp_path):
    (tmp_path / "files" / "projects").mkdir(parents=True)
    (tmp_path / "files" / "projects" / "a.json").write_text('{\n "x": 1\n}')
    (tmp_path / "files" / "projects" / "a.md").write_text("no")
    assert rows(read_documents(spark, str(tmp_path / "files"))) == [("projects/a.json", '{\n "x": 1\n}')]
    assert read_documents(spark, str(tmp_path / "none")).count() == 0
    assert read_responses(spark, str(tmp_path / "none")).count() == 0
