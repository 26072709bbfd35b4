"""Retries, claims, leases and corrections: what a job does when a part of it fails or is repeated."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from partflow.plans.assets import export_snapshot
from partflow.plans.corrections import rewrite_measures
from partflow.plans.publish import PublishJob, publish_dataset, retry_failed
from partflow.plans.reference_data import export_pools
from partflow.sinks.ledger_store import Ledger
from partflow.sinks.partitions import HIVE, publish_partitions
from partflow.sources.inventory import inventory, list_objects
from partflow.sources.probe import broken_footers
from partflow.sources.storage import Move, Retry, Storage
from partflow.spec import DAILY, EPOCH, DatasetSpec
from partflow.streaming.publish import publish_new_partitions

from helpers import responses, rows, write_partition, write_pools

NOW = dt.datetime(2024, 2, 1)
BLOCK = DatasetSpec("block", "block", "slot", DAILY)
POT = DatasetSpec("adapot", "adapot", "epoch", EPOCH)


class Flaky(Storage):
    """Storage that can't put some partitions in their place the first times."""

    refusals: dict[str, int] = {}

    def replace(self, move: Move) -> None:
        name = move.target.rsplit("/", 1)[1]
        if self.refusals.get(name, 0) > 0:
            self.refusals[name] -= 1
            raise OSError(f"no room for {name}")
        super().replace(move)


def test_waits_double_up_to_a_longest():
    retry = Retry()
    assert [retry.wait(n) for n in (1, 2, 3, 4, 5, 9)] == [10, 20, 40, 80, 120, 120] and retry.attempts == 10


def test_a_partition_that_cannot_be_moved_stops_no_other(spark, tmp_path):
    for d in (1, 2, 3):
        write_partition(tmp_path / "in", "block", f"date=2024-01-0{d}", {"slot": [d, d]})
    Flaky.refusals = {"2024-01-01": 2, "2024-01-02": 99}
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    job = PublishJob(str(tmp_path / "in"), str(tmp_path / "out"), ledger, retry=Retry(3, 0, 0), storage=Flaky)
    found = rows(publish_dataset(spark, job, BLOCK, None, NOW), "partition_value", "outcome")
    assert found == [("2024-01-01", "uploaded"), ("2024-01-02", "upload_failed"), ("2024-01-03", "uploaded")]
    assert rows(ledger.uploads(), "partition_value") == [("2024-01-01",), ("2024-01-03",)]
    (error,) = ledger.errors("upload_errors").collect()
    assert (error.partition_value, error.attempts) == ("2024-01-02", 3) and "no room" in error.error_details
    Flaky.refusals = {}
    retry_failed(spark, job, {"block": (BLOCK, None)}, NOW)
    assert rows(ledger.uploads(), "partition_value") == [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]
    assert ledger.errors("upload_errors").count() == 0
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["block"]


def test_footers_are_asked_in_one_job_however_many_are_broken(spark, tmp_path):
    paths = []
    for d in range(1, 9):
        path = write_partition(tmp_path, "block", f"date=2024-01-0{d}", {"slot": [1]})
        if d % 2:
            path.write_bytes(b"PAR1 no parquet at all PAR1" * d)
        paths.append(str(path))
    spark.sparkContext.setJobGroup("footers", "footers")
    found = broken_footers(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2
    assert sorted(r.path.rsplit("=", 1)[1][:10] for r in found.collect()) == [f"2024-01-0{d}" for d in (1, 3, 5, 7)]
    assert broken_footers(spark, []).count() == 0


def test_a_listing_of_some_partitions_opens_their_directories_only(spark, tmp_path, monkeypatch):
    for d in (1, 2, 3):
        write_partition(tmp_path, "block", f"date=2024-01-0{d}", {"slot": [d]})
    assert rows(inventory(spark, str(tmp_path), BLOCK, ["2024-01-02", "2024-01-09"]), "partition_value") == [("2024-01-02",)]
    assert inventory(spark, str(tmp_path), BLOCK, []).count() == 0
    listed = []
    kept = inventory.__globals__["_listing"]
    monkeypatch.setitem(inventory.__globals__, "_listing", lambda s, root, pattern, folders=None: listed.append(folders) or kept(s, root, pattern, folders))
    job = PublishJob(str(tmp_path), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger")))
    publish_new_partitions(spark, job, BLOCK, None, NOW, str(tmp_path / "checkpoint"))
    write_partition(tmp_path, "block", "date=2024-01-04", {"slot": [4]})
    listed.clear()
    publish_new_partitions(spark, job, BLOCK, None, NOW, str(tmp_path / "checkpoint"))
    assert listed and all(folders is not None and all("2024-01-04" in f for f in folders) for folders in listed)
    assert job.ledger.uploads().count() == 4


def test_claims(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda n: ledger.claim_suffix("asset_data", "2024-02-01", f"run {n}"), range(8)))
    assert sorted(numbers) == list(range(1, 9))
    assert ledger.claim_suffix("asset_data", "2024-02-01", "run 3") == numbers[3]
    assert ledger.claim_suffix("asset_data", "2024-02-02", "run 3") == 1


def test_a_snapshot_that_breaks_off_is_repeated_under_its_number(spark, tmp_path, monkeypatch):
    assets = spark.createDataFrame([("T", "n", "c", False), ("", "m", "c", False)], "ticker string, name string, category string, is_meme boolean")
    target, ledger = str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger"))
    assert export_snapshot(spark, assets.limit(0), target, ledger, NOW) is None

    def fail(*args):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr("partflow.plans.assets.publish_day_snapshot", fail)
        with pytest.raises(OSError):
            export_snapshot(spark, assets, target, ledger, NOW)
    assert export_snapshot(spark, assets, target, ledger, NOW + dt.timedelta(hours=2)) == "2024-02-01.2"
    assert export_snapshot(spark, assets, target, ledger, NOW) == "2024-02-01.1"
    assert rows(ledger.uploads(), "partition_value", "row_count") == [("2024-02-01.1", 2), ("2024-02-01.2", 2)]
    assert [r.status for r in ledger.runs().orderBy("run_id").collect()] == ["completed", "failed", "completed", "completed"]


def test_leases(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    first = ledger.start_run("a", NOW)
    ledger.start_run("b", NOW)
    ledger.start_run("a", NOW + dt.timedelta(hours=1))  # the first may still be at work
    assert {r.status for r in ledger.runs().collect()} == {"running"}
    ledger.start_run("a", NOW + dt.timedelta(days=3))
    status = {r.run_id: r.status for r in ledger.runs().collect()}
    assert status == {1: "failed", 2: "running", 3: "failed", 4: "running"}
    ledger.complete_run(first, NOW + dt.timedelta(days=4), 1, 1)  # it was at work after all
    assert ledger.runs().where("run_id = 1").first().status == "completed"


def test_an_export_that_breaks_off_is_closed_as_failed(spark, tmp_path):
    write_pools(tmp_path / "in", "2024-01-10", ["h1"])
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    wrong = responses(spark, ("h1", 200, "{}", None)).drop("body")
    with pytest.raises(Exception, match="body"):
        export_pools(spark, str(tmp_path / "in"), str(tmp_path / "out"), wrong, ledger, NOW)
    (run,) = ledger.runs().collect()
    assert run.status == "failed" and run.error_details and ledger.uploads().count() == 0


def pots(tmp_path):
    for epoch, treasury in ((1, 10), (2, 20), (3, 30), (4, 40)):
        write_partition(tmp_path, "adapot", f"epoch={epoch}", {"note": ["x"], "treasury": [treasury], "epoch": [epoch], "reserves": [1], "fees": [2], "deposits_stake": [3]})


def pot_authority(spark):
    same = {"reserves": "1", "fees": "2", "deposits_stake": "3"}
    known = [{"epoch": 1, "treasury": "10", **same}, {"epoch": 2, "treasury": "21", **same}, {"epoch": 3, "treasury": None, **same}]
    return spark.createDataFrame([tuple(k[c] for c in ("epoch", "treasury", *same)) for k in known], "epoch bigint, treasury string, reserves string, fees string, deposits_stake string")


def test_partitions_are_corrected_where_they_lie(spark, tmp_path):
    pots(tmp_path)
    before = (tmp_path / "adapot" / "epoch=1" / "adapot-epoch-1.parquet").read_bytes()
    ledger, authority = Ledger(spark, str(tmp_path / "ledger")), pot_authority(spark)
    job = lambda **more: rewrite_measures(spark, str(tmp_path), POT, authority, "epoch", ledger, NOW, **more)
    assert rows(job(dry_run=True), "partition_value", "wrong_rows", "outcome") == [("2", 1, "pending"), ("3", 1, "pending")]
    assert ledger.runs().count() == 0
    assert rows(job(), "partition_value", "wrong_rows", "outcome") == [("2", 1, "corrected"), ("3", 1, "corrected")]
    found = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "adapot"))
    assert found.columns == ["note", "treasury", "epoch", "reserves", "fees", "deposits_stake"]
    assert rows(found, "epoch", "treasury", "note") == [(1, 10, "x"), (2, 21, "x"), (3, 0, "x"), (4, 40, "x")]
    assert (tmp_path / "adapot" / "epoch=1" / "adapot-epoch-1.parquet").read_bytes() == before
    assert rows(ledger.uploads(), "partition_value", "row_count", "file_name") == [("2", 1, "adapot-epoch-2.parquet"), ("3", 1, "adapot-epoch-3.parquet")]
    assert job().count() == 0 and ledger.runs().count() == 1
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_a_correction_cut_short_between_the_renames_is_done_by_the_next(spark, tmp_path):
    pots(tmp_path)
    ledger, authority = Ledger(spark, str(tmp_path / "ledger")), pot_authority(spark)

    class Crashing(Storage):
        def replace(self, move):
            if move.target.endswith("epoch=2"):  # the old partition is aside, the new one not there yet
                self.rename(move.target, str(tmp_path / "adapot" / "_replaced-epoch=2"))
                raise OSError("the driver dies")
            super().replace(move)

    job = lambda storage: rewrite_measures(spark, str(tmp_path), POT, authority, "epoch", ledger, NOW, retry=Retry(1, 0, 0), storage=storage)
    assert rows(job(Crashing), "partition_value", "outcome") == [("2", "failed"), ("3", "corrected")]
    assert ledger.errors("upload_errors").count() == 1
    assert rows(job(Storage), "partition_value", "outcome") == [("2", "corrected")]
    found = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "adapot"))
    assert rows(found, "epoch", "treasury") == [(1, 10), (2, 21), (3, 0), (4, 40)]
    assert list_objects(spark, str(tmp_path / "adapot"), "*.parquet").count() == 4


def test_rows_are_written_where_they_are_unless_a_step_moves_them(spark, tmp_path):
    from partflow.sinks.partitions import stays_in_place
    from partflow.sources.partitions import read_partitions

    publish_partitions(spark.range(10).select("id", F.lit("2024-01-01").alias("partition_value")), str(tmp_path), BLOCK, HIVE)
    read = read_partitions(spark, str(tmp_path), BLOCK)
    small = spark.range(5).select("id", F.lit(1).alias("one"))
    assert stays_in_place(read) and stays_in_place(read.join(F.broadcast(small), "id", "left"))
    assert not stays_in_place(read.join(small.hint("merge"), "id", "left"))
