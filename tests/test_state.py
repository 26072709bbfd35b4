import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from partflow.operators import keyed, ledger, profile, versioned
from partflow.operators.catalog import file_counts, file_index, manifest_entries, manifest_summary, manifest_totals
from partflow.sinks.ledger_store import Ledger
from partflow.spec import PROFILE_SCHEMA

from helpers import rows

NOW = dt.datetime(2024, 2, 1)


def test_newest_first_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 1, "k")], "k string, n int, v string"
    )
    assert rows(keyed.newest_per_key(df, ["k"], ["n"]), "k", "v") == [("a", "z"), ("b", "n"), (None, "k")]
    assert rows(keyed.first_per_key(df, ["k"], ["n"]), "k", "v") == [("a", "x"), ("b", "n"), (None, "k")]
    # the answer does not depend on how the rows are split
    assert rows(keyed.newest_per_key(df.repartition(7, "v"), ["k"], ["n"])) == rows(keyed.newest_per_key(df, ["k"], ["n"]))
    assert rows(keyed.newest_per_key(df, ["k"], ["n"], F.count("*").alias("c")), "k", "c") == [("a", 3), ("b", 1), (None, 1)]


def test_upsert_insert_or_ignore_remove(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, seq int, v string")
    new = spark.createDataFrame([("b", 3, "y"), ("b", 2, "z"), ("c", 2, "z")], "k string, seq int, v string")
    assert rows(keyed.upsert(old, new, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "y"), ("c", "z")]
    assert rows(keyed.insert_or_ignore(old, new, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "x"), ("c", "z")]
    assert rows(keyed.remove_keys(old, new, ["k"]), "k") == [("a",)]


# --- profile merge -----------------------------------------------------------

CASES = [
    (status, newer, url, outcome)
    for status, newer, url, outcome in product(
        (None, "success", "failed", "no_url"), (True, False), (True, False), ("success", "failed", "missing")
    )
]


def expected_row(status, newer, url, outcome):
    """(fetch_status, source_block, drep_name, anchor_url, checked, updated) by the rules in words."""
    old_name, old_url = ("Old", "https://old") if status == "success" else (None, None)
    kept = (status, 50, old_name, old_url, "then", "then")
    if status is not None and not newer:
        return kept
    block = 100 if newer else 10
    if url and outcome == "success":
        return ("success", block, "New", "https://new", "now", "now")
    if status == "success":
        return (status, 50, old_name, old_url, "now", "then")
    if not url:
        return ("no_url", block, None, None, "now", "now")
    return ("failed", block, None, "", "now", "now")


def test_merge_ladder(spark):
    existing, registrations, outcomes, expected = [], [], [], {}
    for i, (status, newer, url, outcome) in enumerate(CASES):
        key = f"d{i:02d}"
        if status is not None:
            ok = status == "success"
            existing.append(
                (key, "h", "https://old" if ok else None, None, "Old" if ok else None, 50, 1000, "t", "2024-01-01",
                 status, 200, "then", "then")
            )
        block = 100 if newer else 10
        registrations.append((key, "h2", None, None, block - 1, 0, "t0", "2024-01-05"))
        registrations.append((key, "h2", " https://r " if url else " ", "ah", block, 0, "t1", "2024-01-06"))
        if outcome != "missing":
            good = outcome == "success"
            outcomes.append((key, "https://new" if good else "", "New" if good else None, 200 if good else 404, good))
        expected[key] = expected_row(status, newer, url, outcome)
    existing.append(("kept", "h", None, None, None, 5, 1, "t", "d", "no_url", None, "then", "then"))
    expected["kept"] = ("no_url", 5, None, None, "then", "then")
    schema = "drep_id string, drep_hash string, anchor_url string, anchor_hash string, block bigint, slot bigint, tx_hash string, source_date string"
    newest = profile.newest_registrations(spark.createDataFrame(registrations, schema))
    answers = spark.createDataFrame(
        outcomes, "drep_id string, anchor_url string, drep_name string, http_status int, success boolean"
    )
    held = spark.createDataFrame(existing, PROFILE_SCHEMA)
    batch = newest.drop("anchor_url").join(answers, "drep_id", "left")
    merged = profile.merge_profiles(held, batch, "now")
    assert merged.schema.names == PROFILE_SCHEMA.names
    assert [f.dataType for f in merged.schema.fields] == [f.dataType for f in PROFILE_SCHEMA.fields]
    got = {
        r.drep_id: (r.fetch_status, r.source_block, r.drep_name, r.anchor_url, r.last_checked_at, r.updated_at)
        for r in merged.collect()
    }
    assert got == expected
    assert merged.count() == merged.select("drep_id").distinct().count()


def test_classify_with_null_block(spark):
    newest = spark.createDataFrame([("a", 5, True), ("b", 5, False), ("c", 5, True)], "drep_id string, block bigint, has_url boolean")
    held = spark.createDataFrame([("a", 5), ("b", None), ("c", None)], "drep_id string, source_block bigint")
    assert rows(profile.classify(newest, held), "drep_id", "action") == [("a", "unchanged"), ("b", "no_url"), ("c", "to_resolve")]


# --- versions ----------------------------------------------------------------


def test_candidates_and_versions(spark):
    registered = spark.createDataFrame(
        [("a", "2024-01-10"), ("a", "2024-01-15"), ("b", "2024-01-15"), ("c", "2024-01-01")], "pool_hash string, partition_value string"
    )
    exported = spark.createDataFrame([("a", 1), ("a", 3), ("c", 1)], "pool_hash string, version int")
    day = F.col("partition_value")
    since = versioned.keys_since(registered, "pool_hash", day, "2024-01-10")
    due = versioned.candidates(registered, exported, since, "pool_hash")
    assert rows(due) == [("a",), ("b",)]
    assert versioned.keys_since(registered, "pool_hash", day, "2024-01-15").count() == 0
    no_mark = versioned.keys_since(registered, "pool_hash", day, None)
    assert rows(versioned.candidates(registered, exported, no_mark, "pool_hash")) == [("b",)]
    assert rows(versioned.candidates(registered, exported, no_mark, "pool_hash", rebuild=True)) == [("a",), ("b",), ("c",)]
    assert rows(versioned.distinct_keys(registered, "pool_hash")) == [("a",), ("b",), ("c",)]
    versions = versioned.max_versions(exported, "pool_hash")
    resolved = due.withColumn("success", F.lit(True))
    assert rows(versioned.assign_versions(resolved, versions, "pool_hash"), "pool_hash", "version") == [("a", 4), ("b", 1)]
    rebuilt = versioned.assign_versions(resolved, versions, "pool_hash", rebuild=True)
    assert rows(rebuilt, "pool_hash", "version") == [("a", 1), ("b", 1)]
    assert versioned.assign_versions(resolved.withColumn("success", F.lit(False)), versions, "pool_hash").count() == 0


def test_last_export_compares_epochs_as_numbers(spark):
    df = spark.createDataFrame([("999",), ("1000",)], "e string")
    assert df.agg(versioned.last_export(F.col("e"))).first()[0] == "1000"
    assert df.where("false").agg(versioned.last_export(F.col("e"))).first()[0] is None


# --- ledger ------------------------------------------------------------------


def upload(spark, *records):
    return spark.createDataFrame(
        [(x, p, f"{x}/{p}/f.parquet", n, s, seq) for x, p, n, s, seq in records],
        "exporter string, partition_value string, s3_key string, row_count bigint, status string, event_seq bigint",
    )


def errors(spark, *records):
    return spark.createDataFrame(list(records), "exporter string, partition_value string, error_details string, event_seq bigint")


def test_ledger_store(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    assert book.uploads().count() == 0 and book.watermark("x") is None and book.next_suffix("a", "2024-01-15") == 1
    book.append("uploads", upload(spark, ("a", "1", 5, "completed", 1), ("a", "2", 5, "failed", 1)))
    book.append("uploads", upload(spark, ("a", "1", 7, "completed", 2)))
    assert rows(book.uploads(), "partition_value", "row_count") == [("1", 7), ("2", 5)]
    book.append("upload_errors", errors(spark, ("a", "2", "e", 1), ("a", "3", "e", 1)))
    book.append("validation_errors", errors(spark, ("a", "1", "e", 1), ("b", "9", "e", 1), ("b", "9", "e", 2)))
    assert rows(book.failed()) == [("a", "2"), ("a", "3"), ("b", "9")]
    book.append("cleared_errors", spark.createDataFrame([("b", "9", 1)], "exporter string, partition_value string, event_seq bigint"))
    assert rows(book.errors("validation_errors"), "exporter", "event_seq") == [("a", 1), ("b", 2)]

    listing = spark.createDataFrame(
        [("z/2024-01-15/a.1.parquet", 3), ("z/2024-01-15/a.2.parquet", 4), ("z/7/f.parquet", None), ("index.html", 1)], "key string, size bigint"
    )
    book.replace_uploads(ledger.rebuild_uploads(listing, F.lit(NOW), F.lit(9)))
    assert rows(book.uploads(), "partition_value", "file_name", "file_size", "row_count", "min_slot") == [
        ("2024-01-15", "a.2.parquet", 4, 0, None),
        ("7", "f.parquet", 0, 0, None),
    ]
    book.append("uploads", upload(spark, ("z", "2024-01-15.1", 1, "completed", 10), ("z", "2024-01-15.2", 1, "completed", 10)))
    assert book.next_suffix("z", "2024-01-15") == 3 and book.uploads().count() == 4


def test_runs_and_watermarks(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    for watermark, status in (("999", "completed"), ("1000", "completed"), (None, "completed"), ("2000", "failed"), ("5", "completed")):
        run = book.start_run("x", NOW)
        book.complete_run(run, NOW, 1, 1, status, watermark=watermark)
    open_run = book.start_run("x", NOW)
    assert open_run.run_id == 6
    assert book.watermark("x") == "5" and book.watermark("x", "max") == "1000"
    states = {r.run_id: r.status for r in book.runs().collect()}
    assert states == {1: "completed", 2: "completed", 3: "completed", 4: "failed", 5: "completed", 6: "running"}


def test_old_ledger_files_lack_a_column(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    old = spark.createDataFrame([(1, "x", "completed", 1)], "run_id bigint, exporter string, status string, event_seq bigint")
    old.write.parquet(str(tmp_path / "ledger" / "runs"))
    assert book.watermark("x") is None
    book.complete_run(book.start_run("x", NOW), NOW, 1, 1, watermark="7")
    assert book.watermark("x") == "7"


# --- catalog -----------------------------------------------------------------


def test_manifest(spark):
    objects = spark.createDataFrame(
        [
            ("block/2024-01-16/b.parquet", 2**30, NOW),
            ("block/2024-01-15/a.csv", 2**29, NOW),
            ("reward/9/r.parquet", 5, NOW),
            ("reward/10/r.parquet", 5, NOW),
            ("mixed/2024-01-01/m.parquet", 1, NOW),
            ("mixed/1/m.parquet", 1, NOW),
            ("manifest.json", 5, NOW),
            ("a/b/c/d.parquet", 5, NOW),
            ("block/latest/x.parquet", 5, NOW),
            ("lonely.parquet", 5, NOW),
        ],
        "key string, size bigint, last_modified timestamp",
    )
    entries = manifest_entries(objects)
    assert entries.count() == 6
    summary = manifest_summary(entries)
    assert rows(summary, "exporter", "partition_type", "total_files", "earliest_partition", "latest_partition") == [
        ("block", "daily", 2, "2024-01-15", "2024-01-16"),
        ("mixed", "epoch", 2, "1", "2024-01-01"),
        ("reward", "epoch", 2, "10", "9"),
    ]
    totals = manifest_totals(summary).first()
    assert (totals.total_files, totals.exporters, totals.total_size_gb) == (6, 3, 1.5)
    assert manifest_totals(summary.where("false")).first().total_files == 0
    counted = rows(file_counts(file_index(objects)))
    assert counted == [("a", 1), ("block", 2), ("lonely.parquet", 1), ("mixed", 2), ("reward", 2)]


@pytest.mark.parametrize("mode, expected", [("latest", "5"), ("max", "30")])
def test_watermark_modes(spark, mode, expected):
    runs = spark.createDataFrame([(1, "x", "completed", "30"), (2, "x", "completed", "5")], "run_id bigint, exporter string, status string, source_data_watermark string")
    assert ledger.last_watermarks(runs, mode).first().source_data_watermark == expected
