"""Broken files, cut-short replacements, late sources and dry runs harm nothing else."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from partflow.functions.keys import day_of_epoch_seconds
from partflow.operators.stats import truth_day_bounds, truth_epoch_counts
from partflow.plans import transfer
from partflow.plans.enrichment import Enrichment, run_enrichment
from partflow.plans.migrate import migrate_layout
from partflow.plans.publish import PublishJob, Truth, publish_dataset
from partflow.plans.reference_data import export_registry
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import publish_partitions
from partflow.sources.inventory import list_objects
from partflow.sources.probe import UNREADABLE
from partflow.sources.storage import Move, Retry, Storage
from partflow.spec import DAILY, EPOCH, DatasetSpec, flat_schema

NOW = dt.datetime(2024, 2, 1)
BLOCK = DatasetSpec("block", "block", "slot", DAILY)
SCHEMA = flat_schema("slot bigint, note string")
DAY = 86_400
FIRST = 1_704_067_200


def write(base, day, name, slots):
    folder = base / "block" / f"date=2024-01-{day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    pq.write_table(pa.table({"slot": list(slots), "note": [f"note {s}" for s in slots]}), str(path), use_dictionary=False)
    return path


def break_page(path):
    """Leave the footer whole and spoil the last column's page."""
    data = bytearray(path.read_bytes())
    column = pq.ParquetFile(str(path)).metadata.row_group(0).column(1)
    begin, size = column.data_page_offset, column.total_compressed_size
    data[begin : begin + size] = b"\xff" * size
    path.write_bytes(bytes(data))


def landed(base):
    write(base, 1, "a.parquet", range(0, 10))
    write(base, 2, "a.parquet", range(10, 15))
    write(base, 2, "b.parquet", range(15, 20)).write_bytes(b"broken")
    write(base, 3, "a.parquet", range(20, 30))
    break_page(base / "block" / "date=2024-01-03" / "a.parquet")
    write(base, 4, "a.parquet", [])
    write(base, 5, "a.parquet", range(40, 45))
    write(base, 5, "b.parquet", range(45, 50))
    write(base, 5, "c.parquet", [])


@pytest.mark.parametrize("schema", [SCHEMA, None])
@pytest.mark.parametrize("with_truth", [True, False])
def test_broken_files_stop_no_other_partition(spark, tmp_path, schema, with_truth):
    landed(tmp_path / "in")
    blocks = spark.range(50).select(F.col("id").alias("slot"), (F.lit(FIRST) + F.expr("id div 10") * DAY).alias("t"))
    truth = Truth(blocks, blocks, "slot", day_of_epoch_seconds(F.col("t")).cast("string")) if with_truth else None
    job = PublishJob(str(tmp_path / "in"), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger")), schema)
    found = {r.partition_value[-1]: r.outcome for r in publish_dataset(spark, job, BLOCK, truth, NOW).collect()}
    assert found == {"1": "uploaded", "2": "invalid", "3": "upload_failed", "4": "invalid", "5": "uploaded"}
    details = {r.partition_value[-1]: r.error_details for r in job.ledger.errors("validation_errors").collect()}
    assert details == {"2": UNREADABLE, "4": "Partition holds no rows"}
    assert [r.partition_value for r in job.ledger.errors("upload_errors").collect()] == ["2024-01-03"]
    uploads = {r.partition_value[-1]: r for r in job.ledger.uploads().collect()}
    objects = {r.key: r.size for r in list_objects(spark, job.target, "*.parquet").collect()}
    assert set(uploads) == {"1", "5"} and uploads["1"].s3_key in objects
    assert uploads["1"].file_size == objects[uploads["1"].s3_key]
    assert uploads["5"].file_size == sum(s for k, s in objects.items() if k.startswith("block/2024-01-05/"))
    assert not list(tmp_path.glob("out/_staging*")) and [r.status for r in job.ledger.runs().collect()] == ["completed"]


def test_a_run_that_breaks_off_is_closed_as_failed(spark, tmp_path, monkeypatch):
    write(tmp_path / "in", 1, "a.parquet", range(10))
    job = PublishJob(str(tmp_path / "in"), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger")), SCHEMA)

    def fail(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr("partflow.plans.publish.stage_partitions", fail)
    with pytest.raises(OSError):
        publish_dataset(spark, job, BLOCK, None, NOW)
    run = job.ledger.runs().first()
    assert run.status == "failed" and "no space" in run.error_details


def test_a_replacement_that_is_cut_short_loses_nothing(spark, tmp_path, monkeypatch):
    rows = lambda n: spark.range(n).select("id", F.lit("2024-01-01").alias("partition_value"))
    target = str(tmp_path)
    publish_partitions(rows(5), target, BLOCK)
    published = tmp_path / "block" / "2024-01-01"
    storage = Storage(spark)
    # the new directory can't be moved: the old one comes back
    (moved,) = storage.replace_directories([Move(f"{target}/nowhere", str(published))], Retry(3, 0, 0))
    assert moved.attempts == 3 and "cannot move" in moved.error
    assert spark.read.parquet(str(published)).count() == 5
    # a crash between the two renames leaves the old one aside; the next publication finds it
    storage.rename(str(published), f"{target}/block/_replaced-2024-01-01")
    storage.restore(f"{target}/block")
    assert spark.read.parquet(str(published)).count() == 5
    publish_partitions(rows(7), target, BLOCK)
    assert spark.read.parquet(str(published)).count() == 7
    assert sorted(p.name for p in tmp_path.iterdir()) == ["block"] and [p.name for p in (tmp_path / "block").iterdir()] == ["2024-01-01"]


def test_rows_that_are_partitioned_are_written_without_a_shuffle(spark, tmp_path):
    from partflow.sources.partitions import read_partitions

    write(tmp_path, 1, "a.parquet", range(10))
    rows = read_partitions(spark, str(tmp_path), BLOCK, schema=SCHEMA)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_the_truth_is_pruned(spark, tmp_path):
    spark.range(100).select("id", F.lit("2024-01-01").alias("day"), (F.col("id") % 7).cast("int").alias("epoch")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    days = plan(truth_day_bounds(table, F.col("day"), F.col("id"), "2024-01-01", "2024-01-01"))
    assert "GreaterThanOrEqual(day,2024-01-01), LessThanOrEqual(day,2024-01-01)" in days
    epochs = plan(truth_epoch_counts(table, F.col("epoch"), 3, 3))
    assert "GreaterThanOrEqual(epoch,3), LessThanOrEqual(epoch,3)" in epochs


def test_a_source_that_lands_late_is_not_lost(spark, tmp_path):
    ledger, out = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")
    latest = spark.createDataFrame([("stricahq", "s1"), ("crfa_v2", "c1")], "source string, latest_sha string")
    body = json.dumps({"projectName": "P", "contracts": [{"name": "n", "scriptHash": "a"}]})
    files = spark.createDataFrame([("projects/a.json", body)], "path string, content string")
    export_registry(spark, out, {"crfa_v2": files}, latest, ledger, NOW)
    assert [r.source for r in ledger.registry_state().collect()] == ["crfa_v2"]
    export_registry(spark, out, {"stricahq": files, "crfa_v2": files}, latest, ledger, NOW + dt.timedelta(days=1))
    state = {r.source: r.last_commit_sha for r in ledger.registry_state().collect()}
    assert state == {"crfa_v2": "c1", "stricahq": "s1"}


def test_a_dry_enrichment_leaves_the_published_tree_alone(spark, tmp_path):
    source = DatasetSpec("facts", "", "", EPOCH)
    base, target = str(tmp_path / "in"), str(tmp_path / "out")
    data = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("partition_value"))
    publish_partitions(data, base, source, "hive")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    job = Enrichment("wide", "facts", lambda fact: fact.withColumn("more", F.col("id") * 2))
    assert run_enrichment(spark, job, base, target, ledger, NOW)["uploaded"] == 3
    sizes = {r.file_size > 0 for r in ledger.uploads().collect()}
    assert sizes == {True}
    before = {(r.key, r.size, r.last_modified) for r in list_objects(spark, target).collect()}
    other = Ledger(spark, str(tmp_path / "other"))
    assert run_enrichment(spark, job, base, target, other, NOW, dry_run=True)["enriched"] == 3
    assert {(r.key, r.size, r.last_modified) for r in list_objects(spark, target).collect()} == before
    # one broken file takes no other partition with it
    for path in (tmp_path / "in" / "facts" / "epoch=1").glob("*"):
        path.write_bytes(b"x") if path.suffix == ".parquet" else path.unlink()
    done = run_enrichment(spark, job, base, str(tmp_path / "again"), Ledger(spark, str(tmp_path / "third")), NOW)
    assert (done["uploaded"], done["errors"]) == (2, 1)


def test_a_broken_file_stops_no_other_partition_of_a_migration(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    for n in (1, 2):
        write(tmp_path / "old", n, f"block-2024-01-0{n}.parquet", range(10 * n))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    keys = [("block", f"2024-01-0{n}", f"block/date=2024-01-0{n}/f.parquet", 0) for n in (1, 2)]
    ledger.append("uploads", spark.createDataFrame(keys, "exporter string, partition_value string, s3_key string, event_seq bigint"))
    (tmp_path / "old/block/date=2024-01-02/block-2024-01-02.parquet").write_bytes(b"broken")
    migrate = lambda: {r.partition_value: r for r in migrate_layout(spark, old, new, [BLOCK], NOW, ledger).collect()}
    first = migrate()
    assert first["2024-01-01"].is_published and first["2024-01-01"].found_row_count == 10
    assert not first["2024-01-02"].is_published and "unreadable" in first["2024-01-02"].error_details
    assert {r.s3_key for r in ledger.uploads().collect()} == {"block/2024-01-01/f.parquet", "block/date=2024-01-02/f.parquet"}
    assert [(r.status, r.records_fetched, r.records_exported) for r in ledger.runs().collect()] == [("failed", 2, 1)]
    # repaired, it follows; what is at the target already is written once more
    write(tmp_path / "old", 2, "block-2024-01-02.parquet", range(20))
    assert all(r.is_published for r in migrate().values())
    assert {r.s3_key for r in ledger.uploads().collect()} == {"block/2024-01-01/f.parquet", "block/2024-01-02/f.parquet"}
    assert sorted(r.status for r in ledger.runs().collect()) == ["completed", "failed"]
    # broken again, the target keeps what it has
    (tmp_path / "old/block/date=2024-01-02/block-2024-01-02.parquet").write_bytes(b"broken")
    assert not migrate()["2024-01-02"].is_published
    assert spark.read.parquet(f"{new}/block/2024-01-02").count() == 20
    assert migrate_layout(spark, str(tmp_path / "none"), new, [BLOCK], NOW).count() == 0
    # all footers are whole, but a page of one file is not
    break_page(write(tmp_path / "old", 2, "block-2024-01-02.parquet", range(20)))
    spoiled = migrate()
    assert spoiled["2024-01-01"].is_published and "rows differ" in spoiled["2024-01-02"].error_details


def test_a_migration_that_breaks_off_is_closed_as_failed(spark, tmp_path, monkeypatch):
    write(tmp_path / "old", 1, "block-2024-01-01.parquet", range(10))
    ledger = Ledger(spark, str(tmp_path / "ledger"))

    def no_room(*_, **__):
        raise OSError("no room")

    monkeypatch.setattr(transfer, "stage_partitions", no_room)
    with pytest.raises(OSError):
        migrate_layout(spark, str(tmp_path / "old"), str(tmp_path / "new"), [BLOCK], NOW, ledger)
    assert [(r.status, "no room" in r.error_details) for r in ledger.runs().collect()] == [("failed", True)]
