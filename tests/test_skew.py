"""Slots of heavy keys: even, in order, in several levels, and with rows that have no order value."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from passbook.operators import skew
from passbook.operators.activity import with_activity
from passbook.operators.history import as_of, change_points
from passbook.operators.skew import SLOT, SkewPolicy, placed, with_slot

POLICY = SkewPolicy(min_rows=1000, slot_rows=1000)
LOG = "account_id string, balance decimal(18,2), status string, _cdc_ts_ms bigint, _kafka_partition int, _kafka_offset bigint"


@pytest.fixture(params=[4, 1000])
def cuts(request, monkeypatch):
    monkeypatch.setattr(skew, "CUTS", request.param)
    return request.param


def uneven(spark, n=200_000):
    """Most rows of key a within one hour of ten years, beside a key that is not heavy."""
    hour, years = 3_600_000_000, 10 * 365 * 24 * 3_600_000_000
    at = F.when(F.col("id") % 5 != 0, 5 * hour + F.pmod(F.xxhash64("id"), F.lit(hour))).otherwise(F.pmod(F.xxhash64("id"), F.lit(years)))
    return spark.range(n).select(F.when(F.col("id") % 500 != 0, "a").otherwise("b").alias("k"), at.alias("t"))


def test_slots_stay_small_at_any_number_of_cuts(spark, cuts):
    slotted = with_slot(uneven(spark), "k", F.col("t"), POLICY)
    assert slotted.count() == 200_000 and slotted.filter((F.col("k") == "b") & F.col(SLOT).isNotNull()).isEmpty()
    slots = slotted.filter("k = 'a'").groupBy(SLOT).agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    rows = slots.orderBy(SLOT).collect()
    assert max(r.n for r in rows) <= 2 * POLICY.slot_rows and len(rows) >= 150
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]))


def test_rows_without_order_value_are_split_by_their_place(spark, cuts):
    place = (F.col("id") % 3).cast("int"), F.col("id") * 1000
    rows = spark.range(100_000).select(
        F.lit("a").alias("k"), F.when(F.col("id") % 10 == 0, F.col("id")).alias("t"), place[0].alias("p"), place[1].alias("o")
    )
    slotted = with_slot(rows, "k", placed(F.col("t"), F.col("p"), F.col("o")), POLICY)
    slots = slotted.groupBy(SLOT).agg(F.count("*").alias("n"), F.count("t").alias("timed")).orderBy(SLOT).collect()
    assert max(r.n for r in slots) <= 2 * POLICY.slot_rows
    assert all(r.timed in (0, r.n) for r in slots)
    kinds = [r.timed > 0 for r in slots]
    assert kinds == sorted(kinds, reverse=True)
    bounds = slotted.filter("t is null").groupBy(SLOT).agg(F.min(F.struct("p", "o")).alias("low"), F.max(F.struct("p", "o")).alias("high"))
    ends = bounds.orderBy(SLOT).collect()
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(ends, ends[1:]))


def test_changes_equal_the_unsplit_ones(spark, cuts):
    rows = [
        ("a", Decimal((t * 7) % 5), "ACTIVE", None if t % 4 == 0 else t // 3, t % 2, 2000 * t) for t in range(600)
    ] + [("b", Decimal(t % 2), "ACTIVE", t, 0, 10_000_000 + t) for t in range(5)]
    log = spark.createDataFrame(rows, LOG)
    whole, split = (
        sorted((r._kafka_partition, r._kafka_offset) for r in change_points(log, policy=p).collect())
        for p in (SkewPolicy(), SkewPolicy(min_rows=20, slot_rows=10))
    )
    assert whole == split and len(whole) > 100


def test_features_equal_the_unsplit_ones(spark, cuts):
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(minutes=(k * k) % 9000), "TRANSFER" if k % 3 else "PAYMENT", Decimal(k % 11)) for k in range(400)]
    rows += [("a", None, "TRANSFER", Decimal(1))] * 30 + [(None, start + timedelta(minutes=k), "TRANSFER", Decimal(k)) for k in range(60)]
    frame = spark.createDataFrame(
        rows, "from_account_id string, created_at timestamp_ntz, transaction_type string, amount decimal(18,2)"
    )
    whole, split = (
        sorted(map(repr, with_activity(frame, policy=p).collect())) for p in (SkewPolicy(), SkewPolicy(min_rows=20, slot_rows=10))
    )
    assert whole == split


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(min_rows=2, slot_rows=2)], ids=["whole", "split"])
def test_as_of_without_time_finds_nothing(spark, policy):
    start = datetime(2024, 1, 1)
    versions = spark.createDataFrame(
        [("a", start + timedelta(days=k), start + timedelta(days=k + 1) if k < 9 else None, k, f"v{k}") for k in range(10)]
        + [("a", None, None, 11, "never")],
        "account_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, version_number int, label string",
    )
    facts = spark.createDataFrame(
        [(k, "a", start + timedelta(days=k, hours=1)) for k in range(12)] + [(50, "a", None), (51, None, start), (52, None, None)],
        "id int, account string, at timestamp_ntz",
    )
    found = {r.id: r.label for r in as_of(facts, versions, "account", "at", ["label"], policy=policy).collect()}
    assert found == {k: f"v{min(k, 9)}" for k in range(12)} | {50: None, 51: None, 52: None}
