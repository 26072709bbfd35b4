import random

import pytest
from pyspark.sql import functions as F

from partflow.operators import measures, rangecount
from partflow.operators.assets import clean_assets
from partflow.operators.reconcile import reconcile_daily, reconcile_epoch
from partflow.operators.stats import truth_epoch_counts

from helpers import rows


@pytest.mark.parametrize("spread, n_ranges, bits", [(50, 12, 12), (10_000, 200, 3), (10**12, 40, 12), (10**17, 40, 12), (7, 60, 1)])
def test_count_in_ranges_against_brute_force(spark, monkeypatch, spread, n_ranges, bits):
    monkeypatch.setattr(rangecount, "DIGIT_BITS", bits)
    rng = random.Random(spread)
    hot = rng.randrange(spread)
    points = [rng.randrange(-spread, 2 * spread) for _ in range(600)] + [hot] * 300
    ranges = []
    for i in range(n_ranges):
        low = rng.randrange(spread)
        ranges.append((f"r{i}", low, low + rng.randrange(max(spread // 5, 1))))
    ranges += [("all", -spread, 2 * spread), ("one", hot, hot), ("inverted", 5, 2), ("null", None, None)]
    frame = spark.createDataFrame(ranges, "id string, lo bigint, hi bigint")
    values = spark.createDataFrame([(p,) for p in points], "v bigint")
    got = {r.id: r.in_range for r in rangecount.count_in_ranges(values, F.col("v"), frame, "lo", "hi").collect()}
    expected = {i: 0 if lo is None else sum(lo <= p <= hi for p in points) for i, lo, hi in ranges}
    assert got == expected


def test_count_in_no_ranges(spark):
    frame = spark.createDataFrame([("null", None, None)], "id string, lo bigint, hi bigint")
    got = rangecount.count_in_ranges(spark.range(5), F.col("id"), frame, "lo", "hi")
    assert [r.in_range for r in got.collect()] == [0]


def test_reconcile_daily_outcomes(spark):
    stats = spark.createDataFrame(
        [
            ("2024-01-01", 10, 0, 9),  # fine
            ("2024-01-02", 9, 10, 19),  # one row lost
            ("2024-01-03", 11, 19, 29),  # reaches into the day before, count agrees
            ("2024-01-04", 10, 25, 39),  # both
            ("2024-01-09", 1, 5, 5),  # no such day
            ("2024-01-05", 1, None, None),  # no slots
        ],
        "partition_value string, row_count bigint, min_slot bigint, max_slot bigint",
    )
    truth = spark.range(40).withColumnRenamed("id", "slot")
    bounds = spark.createDataFrame(
        [(f"2024-01-0{d + 1}", d * 10, d * 10 + 9) for d in range(5)], "partition_value string, block_min bigint, block_max bigint"
    )
    got = {r.partition_value: r for r in reconcile_daily(stats, truth, F.col("slot"), bounds).collect()}
    assert {k for k, r in got.items() if r.is_valid} == {"2024-01-01"}
    assert got["2024-01-02"].error_details == "Row count mismatch: parquet=9, pg=10"
    assert got["2024-01-03"].error_details == "Slot range outside block range: pq=[19,29], blocks=[20,29]"
    assert got["2024-01-04"].error_details == (
        "Row count mismatch: parquet=10, pg=15; Slot range outside block range: pq=[25,39], blocks=[30,39]"
    )
    unknown = got["2024-01-09"]
    assert unknown.error_details == "No blocks found in PG for date 2024-01-09"
    assert unknown.pg_count is None and unknown.pg_min_slot is None and unknown.pq_count == 1
    assert got["2024-01-05"].error_details == "Partition holds no slots"


def test_reconcile_epoch(spark):
    stats = spark.createDataFrame([("1", 2), ("2", 2), ("3", 1)], "partition_value string, row_count bigint")
    truth = spark.createDataFrame([(1,), (1,), (2,), (9,)], "epoch int")
    got = reconcile_epoch(stats, truth_epoch_counts(truth, F.col("epoch")))
    assert rows(got, "partition_value", "pg_count", "error_details") == [
        ("1", 2, None),
        ("2", 1, "Row count mismatch: parquet=2, pg=1"),
        ("3", 0, "Row count mismatch: parquet=1, pg=0"),
    ]


@pytest.fixture
def pots(spark):
    own = spark.createDataFrame(
        [
            (1, 10, 20, 3, 4, 101, 81, "keep"),
            (2, 10, 20, 3, 4, 101, 80, "keep"),
            (3, 10, 20, 3, 0, 0, 5, "keep"),
            (4, 10, 20, 3, 4, None, None, "keep"),
            (5, 10, 20, 3, 4, 5, 4, "keep"),
        ],
        "epoch bigint, treasury bigint, reserves bigint, fees bigint, deposits_stake int,"
        " rewards_pot bigint, pool_rewards_pot bigint, other string",
    )
    authority = spark.createDataFrame(
        [(1, "10", "20", "3", "4"), (2, "10", "20", "3", "4"), (3, "10", "20", "3", None), (5, "11", "20", "x", "4")],
        "epoch bigint, treasury string, reserves string, fees string, deposits_stake string",
    )
    return own, authority


def test_measure_report(pots):
    own, authority = pots
    got = {r.epoch: r for r in measures.measure_report(own, authority, "epoch").collect()}
    assert got[1].all_pass and got[3].all_pass
    assert got[2].error_details == "pool_ratio: got=80 expected=81"
    assert not got[4].authority_available and not got[4].all_pass
    assert got[5].error_details == "treasury: parquet=10 authority=11, fees: parquet=3 authority=null"


def test_compare_and_split(pots):
    own, authority = pots
    compared = measures.compare_measures(own, authority, "epoch")
    assert compared.count() == 20
    assert rows(compared.where("not is_match and authority_available"), "epoch", "field") == [(5, "fees"), (5, "treasury")]
    assert rows(measures.check_split(own), "epoch", "expected_pool", "is_match") == [
        (1, 81, True),
        (2, 81, False),
        (5, 4, True),
    ]


def test_split_is_exact_on_large_integers(spark):
    big = 2**62 + 3
    own = spark.createDataFrame([(big, big - big // 5)], "rewards_pot bigint, pool_rewards_pot bigint")
    assert measures.check_split(own).first().is_match


def test_correct_measures(pots):
    own, authority = pots
    fixed = measures.correct_measures(own, authority, "epoch")
    assert fixed.schema.simpleString() == own.schema.simpleString()
    got = {r.epoch: r for r in fixed.collect()}
    assert got[5].treasury == 11 and got[5].other == "keep" and got[5].rewards_pot == 5
    assert (got[4].treasury, got[4].reserves, got[4].fees, got[4].deposits_stake) == (0, 0, 0, 0)


def test_clean_assets(spark):
    assets = spark.createDataFrame(
        [("A", "a", "Stablecoin", True), ("", "b", "DeFi", True), (None, "c", "Stablecoin", None), ("D", "d", None, True)],
        "ticker string, name string, category string, is_meme boolean",
    )
    assert rows(clean_assets(assets), "ticker") == [("D",), ("b",), ("c",)]
