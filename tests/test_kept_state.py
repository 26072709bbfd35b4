"""What is kept between runs: which snapshot is current, manifests as one document, ledgers of older schemas."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from partflow.sinks import snapshots
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.manifests import read_manifest_document, write_manifest_document
from partflow.sinks.snapshots import clean_snapshots, point_to, write_snapshot
from partflow.sinks.versions import compact_versions, highest_versions
from partflow.sources.partitions import latest_snapshot, read_snapshot
from partflow.spec import flat_schema

from helpers import rows

NOW = dt.datetime(2024, 2, 1)
KV = flat_schema("k string, v bigint")


def frame(spark, *values):
    return spark.createDataFrame(list(values), KV)


def test_the_pointer_is_switched_last(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "p")
    write_snapshot(frame(spark, ("a", 1)), root, "0002", "k")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(snapshots, "point_to", dies)
        write_snapshot(frame(spark, ("a", 9)), root, "0003", "k")
    assert rows(read_snapshot(spark, root, KV)) == [("a", 1)]
    # a smaller label, and one in use, become current all the same
    write_snapshot(frame(spark, ("a", 2)), root, "0001", "k")
    assert rows(read_snapshot(spark, root, KV)) == [("a", 2)]
    write_snapshot(frame(spark, ("a", 3)), root, "0001", "k")
    assert rows(read_snapshot(spark, root, KV)) == [("a", 3)]
    point_to(spark, root, "snapshot=0002")  # back to a former one
    assert rows(read_snapshot(spark, root, KV)) == [("a", 1)]
    point_to(spark, root, "snapshot=none")  # there is no such one
    assert rows(read_snapshot(spark, root, KV)) == [("a", 1)]


def test_old_snapshots_are_deleted_by_age(spark, tmp_path):
    root = str(tmp_path / "p")
    for n in (1, 2, 3):
        write_snapshot(frame(spark, ("a", n)), root, f"000{n}", "k")
    point_to(spark, root, "snapshot=0001")
    (tmp_path / "p" / "_staging-left").mkdir()
    assert clean_snapshots(spark, root, dt.timedelta(hours=1)) == []
    assert clean_snapshots(spark, root, dt.timedelta(seconds=-5)) == ["_staging-left", "snapshot=0002", "snapshot=0003"]
    assert latest_snapshot(spark, root).endswith("snapshot=0001")
    assert rows(read_snapshot(spark, root, KV)) == [("a", 1)]


def joined(folder) -> dict:
    return json.loads("".join(p.read_text() for p in sorted(Path(folder).glob("part-*"))))


OBJECTS = [
    ("b/2024-01-02/x.parquet", 5), ("b/2024-01-01/y\"]}.parquet", 7), ("b/2024-01-01/y\"]}.parquet", 7),
    ("a/412/,{\n.csv", 1), ("c/no/shape", 3), ("manifest.json", 2), ("b/old/2024-01-02/z.parquet", 9),
]


def test_a_manifest_in_parts_is_one_document(spark, tmp_path):
    stamped = [(k, s, NOW) for k, s in OBJECTS]
    objects = spark.createDataFrame(stamped, "key string, size long, last_modified timestamp").repartition(4)
    write_manifest_document(objects, str(tmp_path / "m"), NOW)
    document = joined(tmp_path / "m")
    assert (document["generated_at"], document["total_files"], document["exporters"]) == ("2024-02-01T00:00:00", 4, 2)
    held = [[p["s3_key"] for p in e["partitions"]] for e in document["by_exporter"]]
    assert held == [[OBJECTS[3][0]], [OBJECTS[1][0], OBJECTS[1][0], OBJECTS[0][0]]]
    assert [e["total_size_bytes"] for e in document["by_exporter"]] == [1, 19]
    summary, entries = read_manifest_document(spark, str(tmp_path / "m"))
    assert rows(summary, "exporter", "total_files", "latest_partition") == [("a", 1, "412"), ("b", 3, "2024-01-02")]
    assert rows(entries, "s3_key", "file_size_bytes") == sorted([OBJECTS[0], OBJECTS[1], OBJECTS[2], OBJECTS[3]])
    assert entries.where("last_modified = timestamp'2024-02-01'").count() == 4


def test_a_manifest_of_nothing(spark, tmp_path):
    objects = spark.createDataFrame([], "key string, size long, last_modified timestamp")
    write_manifest_document(objects, str(tmp_path / "m"), NOW)
    assert joined(tmp_path / "m")["by_exporter"] == []
    assert [f.count() for f in read_manifest_document(spark, str(tmp_path / "m"))] == [0, 0]


def test_ledger_files_of_older_schemas(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    folder = Path(ledger.folder("runs"))
    folder.mkdir(parents=True)
    old = {"run_id": pa.array([1, 2], pa.int32()), "exporter": ["a", "a"], "event_seq": pa.array([2, 0], pa.int32()), "host": ["h", "h"]}
    pq.write_table(pa.table(old), str(folder / "old.parquet"))
    run = ledger.start_run("a", NOW)
    assert run.run_id == 3
    ledger.complete_run(run, NOW, 5, 5)
    before = rows(ledger.events("runs"))
    assert len(before) == 4
    assert ledger.compact("runs") == 3
    assert rows(ledger.events("runs")) == before and len(list(folder.glob("*.parquet"))) == 1
    assert ledger.compact("runs") == 1 and ledger.compact("upload_errors") == 0
    assert rows(ledger.runs(), "run_id", "status") == [(1, None), (2, None), (3, "completed")]


def test_a_compaction_broken_off_is_mended_by_the_next(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    schema = "exporter string, partition_value string, row_count long, event_seq long"
    for n in (1, 2, 3):
        ledger.append("uploads", spark.createDataFrame([("a", "2024-01-01", n, n), ("b", "2024-01-01", n, n)], schema))
    before = rows(ledger.events("uploads"))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr("partflow.sources.storage.Storage.delete", dies)
        ledger.compact("uploads")
    assert rows(ledger.uploads(), "exporter", "row_count") == [("a", 3), ("b", 3)]
    ledger.compact("uploads")
    assert rows(ledger.events("uploads")) == before


def test_a_run_reads_the_version_state_and_what_came_after_it(spark, tmp_path):
    out, key = str(tmp_path / "out"), flat_schema("k string")["k"]
    highest = lambda: highest_versions(spark, out, "pools", key)

    def export(n, *values):
        path = f"{out}/pools/date=2024-01-0{n}/export={n}"
        spark.createDataFrame(list(values), "k string, version int, text string").coalesce(1).write.mode("overwrite").parquet(path)

    assert rows(highest()) == [] and not compact_versions(spark, out, "pools", key, after=0)
    export(1, ("a", 1, "x"), ("b", 1, "x"), (None, 4, "x"))
    export(2, ("a", 2, "x"), ("a", 2, "x"))
    assert not compact_versions(spark, out, "pools", key, after=3)
    assert compact_versions(spark, out, "pools", key, after=2)
    read = lambda: {path.split("/out/")[1].rsplit("/", 1)[0] for path in highest().inputFiles()}
    assert all(folder.startswith("_versions/pools/state=000001-") for folder in read())
    export(3, ("b", 2, "x"), ("c", 1, "x"))
    assert {folder.split("/")[0] for folder in read()} == {"_versions", "pools"} and "pools/date=2024-01-03/export=3" in read()
    assert rows(highest()) == [("a", 2), ("b", 2), ("c", 1), (None, 4)]
    # what is not known to be whole is read, but never covered
    (Path(out) / "pools/date=2024-01-03/export=3/_SUCCESS").unlink()
    assert not compact_versions(spark, out, "pools", key, after=1)
    export(4, ("c", 7, "x"))
    assert compact_versions(spark, out, "pools", key, after=1)
    assert rows(highest()) == [("a", 2), ("b", 2), ("c", 7), (None, 4)]
    assert "pools/date=2024-01-03/export=3" in read() and "pools/date=2024-01-04/export=4" not in read()
    # a state whose writer died is passed over
    (state,) = Path(out).glob("_versions/pools/state=000002-*")
    (state.parent / "state=000003-x" / "keys").mkdir(parents=True)
    assert rows(highest()) == [("a", 2), ("b", 2), ("c", 7), (None, 4)]
    # an export that is written anew or taken back makes the state void
    export(4, ("c", 3, "x"))
    assert rows(highest()) == [("a", 2), ("b", 2), ("c", 3), (None, 4)]
    export(5, ("d", 1, "x"))
    assert compact_versions(spark, out, "pools", key, after=1)
    assert len(list(Path(out).glob("_versions/pools/state=*/keys/_SUCCESS"))) == 2
    assert rows(highest()) == [("a", 2), ("b", 2), ("c", 3), ("d", 1), (None, 4)]
