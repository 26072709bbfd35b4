import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partflow.catalogue import CATALOGUE
from partflow.functions.keys import day_of_epoch_seconds
from partflow.operators import registry
from partflow.operators.ledger import run_summary
from partflow.operators.selection import requested_values
from partflow.plans.enrichment import profile_enrichment, run_enrichment
from partflow.plans.migrate import migrate_layout
from partflow.plans.profile import build_profile, pending_lookups
from partflow.plans.publish import PublishJob, Truth, publish_dataset, retry_failed
from partflow.plans.reference_data import export_pools, export_registry
from partflow.sinks.documents import write_documents
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.manifests import write_file_index, write_manifest
from partflow.sinks.partitions import publish_day_snapshot, publish_partitions, published_stats, verify_published
from partflow.sources.documents import read_documents
from partflow.sources.inventory import list_objects
from partflow.sources.partitions import read_exports, read_partitions, read_snapshot
from partflow.spec import DAILY, EPOCH, POOL_DATA_SCHEMA, PROFILE_SCHEMA, DatasetSpec, flat_schema
from partflow.streaming.discover import collect_stats, each_new_batch, file_stream
from partflow.streaming.publish import publish_new_partitions

from helpers import responses, rows, write_partition, write_pools, write_registrations

NOW = dt.datetime(2024, 2, 1)
BLOCK = DatasetSpec("block", "block", "slot", DAILY)
REWARD = DatasetSpec("reward", "reward", "earned_epoch", EPOCH)
BLOCK_SCHEMA = flat_schema("slot bigint, note string")
DAY = 86_400
FIRST = 1_704_067_200  # 2024-01-01


@pytest.fixture
def truth(spark):
    """Ten blocks a day for five days from 2024-01-01."""
    blocks = spark.range(50).select(F.col("id").alias("slot"), (F.lit(FIRST) + F.expr("id div 10") * DAY).alias("block_time"))
    return Truth(blocks, blocks, "slot", day_of_epoch_seconds(F.col("block_time")).cast("string"))


@pytest.fixture
def job(spark, tmp_path):
    """Three good days, one that lost a row, one unreadable, one unknown."""
    for day in (1, 2, 3):
        write_day(tmp_path / "in", day, range((day - 1) * 10, day * 10))
    write_day(tmp_path / "in", 4, range(30, 39))
    write_day(tmp_path / "in", 9, range(5))
    broken = write_day(tmp_path / "in", 5, range(40, 50))
    broken.write_bytes(b"broken")
    return PublishJob(
        str(tmp_path / "in"), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger")), BLOCK_SCHEMA
    )


def write_day(base, day, slots):
    slots = list(slots)
    # numbers with a hole stay inside the range, so only the count is wrong
    if len(slots) == 9:
        slots = slots[:-1] + [slots[-1] + 1]
    return write_partition(base, "block", f"date=2024-01-{day:02d}", {"slot": slots, "note": ["x"] * len(slots)})


def outcomes(results):
    return {r.partition_value[-2:]: r.outcome for r in results.collect()}


def test_publish(spark, job, truth):
    results = publish_dataset(spark, job, BLOCK, truth, NOW)
    assert outcomes(results) == {"01": "uploaded", "02": "uploaded", "03": "uploaded", "04": "invalid", "05": "invalid", "09": "invalid"}
    summary = run_summary(results).first()
    assert (summary.scanned, summary.validated, summary.validation_errors, summary.uploaded) == (6, 6, 3, 3)
    uploads = {r.partition_value: r for r in job.ledger.uploads().collect()}
    first = uploads["2024-01-01"]
    assert first.s3_key == "block/2024-01-01/block-2024-01-01.parquet" and first.file_size > 0
    assert (first.row_count, first.min_slot, first.max_slot) == (10, 0, 9)
    details = {r.partition_value[-2:]: r.error_details for r in job.ledger.errors("validation_errors").collect()}
    assert details == {
        "04": "Row count mismatch: parquet=9, pg=10",
        "05": "Parquet read error: unreadable file",
        "09": "No blocks found in PG for date 2024-01-09",
    }
    stats = published_stats(spark.createDataFrame([], BLOCK_SCHEMA), job.target, BLOCK, ["2024-01-01", "2024-01-04"], F.col("slot"))
    assert rows(stats, "partition_value", "row_count", "min_slot", "max_slot") == [("2024-01-01", 10, 0, 9)]
    # a second run only looks at what is left
    again = publish_dataset(spark, job, BLOCK, truth, NOW)
    assert set(outcomes(again).values()) == {"skipped", "invalid"}
    assert job.ledger.uploads().count() == 3


def test_publish_selection_and_dry_run(spark, job, truth):
    wanted = requested_values(spark, ["2024-01-02", "2024-01-04", "2031-01-01"])
    results = publish_dataset(spark, job, BLOCK, truth, NOW, wanted, dry_run=True)
    found = outcomes(results)
    assert found["02"] == "uploaded" and found["04"] == "invalid" and found["01"] == "not_requested"
    assert job.ledger.uploads().count() == 0 and job.ledger.errors("validation_errors").count() == 0
    assert list_objects(spark, job.target).count() == 0


def test_retry(spark, job, truth):
    publish_dataset(spark, job, BLOCK, truth, NOW).count()
    assert job.ledger.failed().count() == 3
    # one day is repaired, one is published by hand without validation
    write_day(job.base, 4, range(30, 40))
    summary = retry_failed(spark, job, {"block": (BLOCK, truth)}, NOW).first()
    assert (summary.scanned, summary.uploaded, summary.validation_errors) == (3, 1, 2)
    assert rows(job.ledger.failed(), "partition_value") == [("2024-01-05",), ("2024-01-09",)]
    by_hand = requested_values(spark, ["2024-01-09"])
    publish_dataset(spark, job, BLOCK, None, NOW, by_hand).count()
    record = job.ledger.uploads().where("partition_value = '2024-01-09'").first()
    assert (record.row_count, record.min_slot) == (0, None)
    # its errors stay, yet it no longer counts as failed
    assert rows(job.ledger.failed(), "partition_value") == [("2024-01-05",)]
    assert job.ledger.errors("validation_errors").where("partition_value = '2024-01-09'").count() > 0
    assert retry_failed(spark, job, {}, NOW) is None


def test_publish_epochs(spark, tmp_path):
    for epoch, n in (("9", 2), ("10", 3)):
        write_partition(tmp_path / "in", "reward", f"epoch={epoch}", {"earned_epoch": [int(epoch)] * n})
    job = PublishJob(str(tmp_path / "in"), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger")))
    table = spark.createDataFrame([(9,), (9,), (10,)], "earned_epoch bigint")
    results = publish_dataset(spark, job, REWARD, Truth(table), NOW)
    assert {r.partition_value: r.outcome for r in results.collect()} == {"9": "uploaded", "10": "invalid"}
    assert job.ledger.uploads().first().s3_key == "reward/9/reward-epoch-9.parquet"


def test_publishing_twice_changes_nothing(spark, tmp_path):
    target = str(tmp_path)
    data = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("partition_value"))
    spec = DatasetSpec("d", "", "id", EPOCH)
    for _ in range(2):
        assert len(publish_partitions(data, target, spec)) == 101
        stats = published_stats(data, target, spec, ["hot", "950"], F.col("id"))
        assert rows(stats, "partition_value", "row_count") == [("950", 1), ("hot", 900)]


def test_verify_notices_what_is_missing(spark):
    text = "partition_value string, row_count bigint"
    expected = spark.createDataFrame([("1", 5), ("2", 5), ("3", 5)], text)
    found = spark.createDataFrame([("1", 5), ("2", 4), ("4", 1)], text)
    assert rows(verify_published(expected, found).where("not is_published"), "partition_value") == [("2",), ("3",), ("4",)]


def test_day_snapshots(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    target = str(tmp_path / "out")
    for expected in ("2024-01-15.1", "2024-01-15.2"):
        suffix = ledger.next_suffix("asset_data", "2024-01-15")
        value = publish_day_snapshot(spark.range(3), target, "asset_data", "2024-01-15", suffix)
        assert value == expected
        record = spark.createDataFrame([("asset_data", value, "completed", 1)], "exporter string, partition_value string, status string, event_seq bigint")
        ledger.append("uploads", record)
    assert spark.read.option("recursiveFileLookup", True).parquet(target).count() == 6


def name_body(name):
    return json.dumps({"url": "https://" + name, "json_metadata": {"body": {"givenName": name}}})


def test_profile_job(spark, tmp_path):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    nothing = build_profile(spark, base, out, responses(spark, ("x", 404, None, None)), "0", "t0", rebuild=True)
    assert nothing["keys_read"] == 0
    write_registrations(tmp_path / "in", "2024-01-15", [("d1", "https://m", 100), ("d1", None, 90)])
    write_registrations(tmp_path / "in", "2024-01-16", [("d2", None, 200)])
    assert rows(pending_lookups(spark, base, out)) == [("d1",)]
    landed = responses(spark, ("d1", 200, name_body("alice"), None))
    dry = build_profile(spark, base, out, landed, "1", "t1", rebuild=True, dry_run=True)
    assert dry["actions"] == {"to_resolve": 1, "no_url": 1} and dry["profiles_after"] == 0
    first = build_profile(spark, base, out, landed, "1", "t1", rebuild=True)
    assert (first["profiles_before"], first["profiles_after"]) == (0, 2)
    write_registrations(tmp_path / "in", "2024-01-20", [("d1", "https://broken", 300), ("d3", "https://x", 301)])
    failed = responses(spark, ("d1", 404, None, None))
    second = build_profile(spark, base, out, failed, "2", "t2", dates=["2024-01-20"])
    assert (second["profiles_before"], second["profiles_after"]) == (2, 3)
    profile = read_snapshot(spark, out + "/drep_profile", PROFILE_SCHEMA)
    assert rows(profile, "drep_id", "fetch_status", "drep_name", "anchor_url", "source_block", "source_date", "last_checked_at") == [
        ("d1", "success", "alice", "https://alice", 100, "2024-01-15", "t2"),
        ("d2", "no_url", None, None, 200, "2024-01-16", "t1"),
        ("d3", "failed", None, "", 301, "2024-01-20", "t2"),
    ]


def pool_body(ticker):
    return json.dumps({"pool_id": "pool1", "ticker": ticker, "name": "n"})


def test_pool_exports(spark, tmp_path):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    none = responses(spark, ("zz", 404, None, None))
    assert export_pools(spark, base, out, none, ledger, NOW) is None
    write_pools(tmp_path / "in", "2024-01-10", ["h1", "h2", "h1"])
    both = responses(spark, ("h1", 200, pool_body("A"), None), ("h2", 404, None, None))
    assert rows(export_pools(spark, base, out, both, ledger, NOW), "pool_hash", "ticker", "version") == [("h1", "A", 1)]
    assert ledger.watermark("off_chain_pool_data") == "2024-01-10"
    # nothing new but the one that failed, which fails again
    assert export_pools(spark, base, out, both, ledger, NOW + dt.timedelta(days=1)) is None
    write_pools(tmp_path / "in", "2024-01-15", ["h1", "h3"])
    later = responses(spark, ("h1", 200, pool_body("B"), None), ("h3", 200, pool_body("C"), None))
    third = export_pools(spark, base, out, later, ledger, NOW + dt.timedelta(days=2))
    assert rows(third, "pool_hash", "ticker", "version") == [("h1", "B", 2), ("h3", "C", 1)]
    assert third.schema.names == POOL_DATA_SCHEMA.names
    assert ledger.watermark("off_chain_pool_data") == "2024-01-15"
    assert read_exports(spark, out, "off_chain_pool_data", POOL_DATA_SCHEMA).count() == 3
    rebuilt = export_pools(spark, base, out, later, ledger, NOW, rebuild=True, dry_run=True)
    assert rows(rebuilt, "pool_hash", "version") == [("h1", 1), ("h3", 1)]
    assert ledger.runs().count() == 4


def contracts(project, *hashes):
    items = [{"scriptHash": h, "name": "c", "language": "Plutus", "purpose": "spend"} for h in hashes]
    return json.dumps({"projectName": project, "category": "DeFi", "contracts": items})


def test_registry_exports(spark, tmp_path):
    out = str(tmp_path / "out")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    docs = "path string, content string"
    heads = "source string, latest_sha string"

    def run(sha, files, changes=None, day=0):
        latest = spark.createDataFrame([("stricahq", sha), ("crfa_v2", "same")], heads)
        landed = {
            "stricahq": spark.createDataFrame(files, docs),
            "crfa_v2": spark.createDataFrame([("dApps_v2/x.json", json.dumps({"dAppName": "V2", "scripts": [{"scriptHash": "a", "name": "s"}, {"scriptHash": "v2", "name": "s"}]}))], docs),
        }
        return export_registry(spark, out, landed, latest, ledger, NOW + dt.timedelta(days=day), changes)

    first = run("s1", [("projects/a.json", contracts("P", "a", "b"))])
    assert rows(first, "script_hash", "project_name", "version") == [("a", "P", 1), ("b", "P", 1), ("v2", "V2", 1)]
    assert rows(ledger.registry_hashes(), "script_hash", "source") == [("a", "stricahq"), ("b", "stricahq"), ("v2", "crfa_v2")]
    seen = {r.script_hash: r.first_seen_at for r in ledger.registry_hashes().collect()}
    # unchanged revisions export nothing
    assert run("s1", [("projects/a.json", contracts("P", "a"))], day=1) is None
    # only the changed file is read again
    changed = spark.createDataFrame([("projects/b.json", "modified"), ("projects/b.md", "added")], "filename string, status string")
    files = [("projects/a.json", contracts("Ignored", "a")), ("projects/b.json", contracts("Q", "b", "new"))]
    second = run("s2", files, {"stricahq": changed}, day=2)
    assert rows(second, "script_hash", "project_name", "version") == [("b", "Q", 2), ("new", "Q", 1)]
    again = {r.script_hash: r.first_seen_at for r in ledger.registry_hashes().collect()}
    assert again["b"] == seen["b"] and again["new"] == NOW + dt.timedelta(days=2)
    # an empty difference still moves the revision
    nothing = spark.createDataFrame([("projects/b.md", "modified")], "filename string, status string")
    assert run("s3", files, {"stricahq": nothing}, day=3) is None
    assert rows(ledger.registry_state(), "source", "last_commit_sha") == [("crfa_v2", "same"), ("stricahq", "s3")]
    # without a known difference everything is read
    assert run("s4", files, day=4).count() == 3
    assert registry.PARSERS.keys() == registry.PREFIXES.keys() == set(registry.SOURCES)


def write_dist(base, epoch, ids):
    kinds = pa.array(["key"] * len(ids)).dictionary_encode()
    write_partition(base, "drep_dist", f"epoch={epoch}", {"drep_id": ids, "drep_type": kinds, "amount": [1] * len(ids), "epoch": [epoch] * len(ids)})


def test_enrichment_job(spark, tmp_path):
    base, out, target = str(tmp_path / "in"), str(tmp_path / "prof"), str(tmp_path / "out")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    write_dist(tmp_path / "in", 999, ["d1", "d1", "d9"])
    without = run_enrichment(spark, profile_enrichment(spark, out), base, target, ledger, NOW, dry_run=True)
    assert without["enriched"] == 1 and without["uploaded"] == 0 and ledger.runs().count() == 0
    write_registrations(tmp_path / "in", "2024-01-15", [("d1", "https://m", 100)])
    build_profile(spark, base, out, responses(spark, ("d1", 200, name_body("alice"), None)), "1", "t", rebuild=True)
    first = run_enrichment(spark, profile_enrichment(spark, out), base, target, ledger, NOW)
    assert (first["scanned"], first["uploaded"], first["errors"]) == (1, 1, 0)
    write_dist(tmp_path / "in", 1000, ["d1"])
    write_dist(tmp_path / "in", 1001, ["d1"])
    only = requested_values(spark, ["999", "1000"])
    second = run_enrichment(spark, profile_enrichment(spark, out), base, target, ledger, NOW, only)
    assert (second["scanned"], second["skipped_existing"], second["enriched"]) == (3, 1, 1)
    assert ledger.watermark("drep_dist_enriched") == "1000"
    got = spark.read.option("recursiveFileLookup", True).parquet(target + "/drep_dist_enriched/999")
    assert got.columns == ["drep_id", "drep_type", "amount", "anchor_url", "drep_name"]
    assert rows(got, "drep_id", "drep_name") == [("d1", "alice"), ("d1", "alice"), ("d9", None)]
    idle = run_enrichment(spark, profile_enrichment(spark, out), base, target, ledger, NOW, only)
    assert idle["enriched"] == 0 and ledger.watermark("drep_dist_enriched") == "1000"
    assert rows(ledger.uploads(), "s3_key") == [
        ("drep_dist_enriched/1000/drep_dist_enriched-epoch-1000.parquet",),
        ("drep_dist_enriched/999/drep_dist_enriched-epoch-999.parquet",),
    ]


def test_layout_migration(spark, tmp_path):
    write_day(tmp_path / "old", 1, range(10))
    write_day(tmp_path / "old", 2, range(10, 20))
    source, target = str(tmp_path / "old"), str(tmp_path / "new")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    record = "exporter string, partition_value string, s3_key string, row_count bigint, event_seq bigint"
    ledger.append("uploads", spark.createDataFrame([("block", "2024-01-01", "block/date=2024-01-01/f.parquet", 10, 0), ("r", "7", "r/7/f.parquet", 1, 0)], record))
    moves = migrate_layout(spark, source, target, [BLOCK], NOW, ledger, dry_run=True)
    assert rows(moves, "old_key", "new_key")[0] == ("block/date=2024-01-01/block-2024-01-01.parquet", "block/2024-01-01/block-2024-01-01.parquet")
    assert list_objects(spark, target).count() == 0
    done = migrate_layout(spark, source, target, [BLOCK], NOW, ledger)
    assert rows(done, "exporter", "partition_value", "is_published") == [("block", "2024-01-01", True), ("block", "2024-01-02", True)]
    assert rows(ledger.uploads(), "s3_key", "row_count") == [("block/2024-01-01/f.parquet", 10), ("r/7/f.parquet", 1)]
    assert read_partitions(spark, source, BLOCK).count() == 20


def test_manifests(spark, tmp_path):
    write_day(tmp_path / "tree", 1, range(3))
    (tmp_path / "tree" / "block" / "2024-01-02").mkdir(parents=True)
    write_partition(tmp_path / "tree", "block", "2024-01-02", {"slot": [1]})
    objects = list_objects(spark, str(tmp_path / "tree"))
    target = str(tmp_path / "manifest")
    write_manifest(objects, target, NOW)
    totals = spark.read.json(target + "/totals").first()
    assert totals.total_files == 1 and totals.generated_at == "2024-02-01T00:00:00"
    assert spark.read.json(target + "/exporters").first().latest_partition == "2024-01-02"
    assert spark.read.json(target + "/partitions").first().s3_key == "block/2024-01-02/block-2024-01-02.parquet"
    write_file_index(objects, target + "-index", NOW)
    assert spark.read.json(target + "-index/totals").first().total_files == 2
    assert spark.read.json(target + "-index/exporters").first().file_count == 2


def test_stream_sees_each_file_once(spark, tmp_path):
    schema = flat_schema("slot bigint, note string, date string")
    source, state, mark = (str(tmp_path / n) for n in ("in/block", "state", "mark"))
    write_day(tmp_path / "in", 1, range(10))
    write_day(tmp_path / "in", 2, range(10, 20))

    def run():
        return collect_stats(file_stream(spark, source, schema, max_files=1), F.col("date"), F.col("slot"), state, mark)

    assert rows(run(), "partition_value", "row_count", "max_slot") == [("2024-01-01", 10, 9), ("2024-01-02", 10, 19)]
    write_day(tmp_path / "in", 3, range(20, 30))
    write_partition(tmp_path / "in", "block", "date=2024-01-01", {"slot": [100], "note": ["late"]}, "late.parquet")
    seen = []
    each_new_batch(file_stream(spark, source, schema), str(tmp_path / "other"), lambda df, i: seen.append(df.count()))
    assert seen == [31]
    assert rows(run(), "partition_value", "row_count", "max_slot") == [
        ("2024-01-01", 11, 100),
        ("2024-01-02", 10, 19),
        ("2024-01-03", 10, 29),
    ]
    assert run().count() == 3


def test_stream_publishes_new_partitions(spark, job, truth, tmp_path):
    mark = str(tmp_path / "mark")
    publish_new_partitions(spark, job, BLOCK, truth, NOW, mark)
    assert rows(job.ledger.uploads(), "partition_value") == [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]
    # a file under a known name is not new: repairing it is a matter for a retry
    broken = write_day(job.base, 5, range(40, 50))
    publish_new_partitions(spark, job, BLOCK, truth, NOW, mark)
    assert job.ledger.uploads().count() == 3
    broken.unlink()
    write_partition(job.base, "block", "date=2024-01-05", {"slot": list(range(40, 50)), "note": ["x"] * 10}, "part-0.parquet")
    publish_new_partitions(spark, job, BLOCK, truth, NOW, mark)
    assert job.ledger.uploads().where("partition_value = '2024-01-05'").count() == 1


def test_documents_are_files_of_one_directory(spark, tmp_path):
    root = tmp_path / "documents"
    written = [(1, "one"), (2, "ü\u2028two"), (2, "another"), (-3, ""), (4, None), (None, "nobody's")] + [(n, f"text {n}") for n in range(10, 200)]
    write_documents(spark.createDataFrame(written, "k long, value string").repartition(7), str(root))
    assert not [p for p in root.iterdir() if p.is_dir() or not p.name.startswith("k=")]
    want = {"k=1.txt": "one\n", "k=2.txt": "another\nü\u2028two\n", "k=-3.txt": "\n", "k=4.txt": "\n", "k=__HIVE_DEFAULT_PARTITION__.txt": "nobody's\n"}
    want |= {f"k={n}.txt": f"text {n}\n" for n in range(10, 200)}
    assert rows(read_documents(spark, str(root), "*.txt")) == sorted(want.items())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # as little as counts for opening one file
    try:
        found = read_documents(spark, str(root), "*.txt")
        assert found.rdd.getNumPartitions() == 4 * 4
        assert rows(found) == sorted(want.items())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_landed_documents_list_one_directory(spark, tmp_path, monkeypatch):
    # a directory for each file has to be made, moved and listed: at 60,000 suppliers most of the time
    tables, shared = tmp_path / "tables", tmp_path / "shared"
    suppliers = [(n, f"Supplier {n}") for n in range(300)] + [(300, None), (7, "Supplier 7")]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").repartition(3).write.parquet(f"{tables}/supplier.parquet")
    customers = [(1, "a", "X", 2.5), (2, "b", "Y", -1.0), (3, "c", "Z", None)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double").write.parquet(f"{tables}/customer.parquet")
    monkeypatch.setattr("partflow.catalogue.jobs.new_dir", lambda spark, label: f"{shared}/{label}")
    found = rows(CATALOGUE["landed_documents"].run(spark, str(tables)))
    files = {("file", str(n), f"Supplier {n}", True) for n in range(300)} | {("file", "300", None, True)}
    assert {r for r in found if r[0] == "file"} == files
    assert {r for r in found if r[0] == "response"} == {("response", "1", "a", True), ("response", "2", None, False)}
    assert len(found) == 303
    assert len([p for p in (shared / "files").iterdir() if p.suffix == ".txt"]) == 301
    assert not [p for p in (shared / "files").iterdir() if p.is_dir()]
