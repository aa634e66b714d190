"""Versioned marts: publishing behind the gate, refreshing affected keys only."""

import pytest
from pyspark.sql import functions as F

from passbook import fixtures as fx
from passbook.operators import envelope as ev
from passbook.operators.quality import QualityError
from passbook.plans import refresh
from passbook.sources import landing, martstore, pointer
from passbook.workspace import fresh_path, stored

SF = "/root/testdata/sf0.001"


def at():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


MARTS = ("dim_customers", "dim_accounts", "fact_transactions", "mart_suspicious_transactions")


def logs(spark):
    return {
        "customers": fx.customer_log(spark, SF).filter("cast(customer_id as int) < 40"),
        "accounts": fx.account_log(spark, SF),
        "transactions": fx.transaction_log(spark, SF),
    }


def land(base, parts):
    for name, rows in parts.items():
        landing.write_rows(ev.with_partitions(rows), base, name)


def content(spark, base, name):
    rows = martstore.read_mart(spark, base, name)
    return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))


def test_refresh_equals_a_full_build_and_a_failed_gate_changes_nothing(spark):
    base, marts, whole = (fresh_path(spark, n) for n in ("landing", "marts", "whole"))
    every = logs(spark)
    # the second delivery: late customers, two accounts' changes of all days, first events of some transactions
    late = {
        "customers": F.col("customer_id") == "7",
        "accounts": F.col("account_id").isin("3", "4") & (F.col("_kafka_offset") % 3 == 0),
        "transactions": F.col("from_account_id").isin("3", "5") & (F.col("_kafka_offset") % 4 == 0) & (F.col("_cdc_op") == "c"),
    }
    land(base, {n: rows.filter(~late[n]) for n, rows in every.items()})
    results = refresh.full(spark, base, marts, anchor="2024-01-15", flagged_at=at(), buckets=8)
    assert results.filter("failing_rows > 0").count() == 0
    first = martstore.version(spark, marts)
    old = {n: content(spark, marts, n) for n in MARTS}

    land(base, {n: rows.filter(late[n]) for n, rows in every.items()})
    # an event before the first one known, which names another account
    moved = every["transactions"].filter("_cdc_op = 'c' and from_account_id = '5'").orderBy("_kafka_offset").limit(1)
    moved = moved.withColumns({"from_account_id": F.lit("6"), "_cdc_ts_ms": F.col("_cdc_ts_ms") - 5000, "_kafka_offset": F.lit(10**9 * 5)})
    land(base, {"transactions": moved})
    landing.close_hours(spark, base, "accounts")  # what has been read may come again in a closed hour
    refresh.refresh(spark, base, marts, flagged_at=at())
    refresh.full(spark, base, whole, anchor="2024-01-15", flagged_at=at(), buckets=3)
    for name in MARTS:
        assert content(spark, marts, name) == content(spark, whole, name), name
    assert content(spark, marts, "fact_transactions") != old["fact_transactions"]

    # readers of the first build still see it, and untouched buckets were not written again
    rows = martstore.read_mart(spark, marts, "dim_accounts", of=first)
    assert sorted(map(repr, rows.select(*sorted(rows.columns)).collect())) == old["dim_accounts"]
    now = martstore.version(spark, marts)
    kept = [
        k for k, g in now["marts"]["fact_transactions"]["generations"].items() if g == first["marts"]["fact_transactions"]["generations"][k]
    ]
    assert kept

    # bad rows land: the gate stops the refresh, the marts stay
    bad = every["accounts"].filter("_cdc_op <> 'd'").limit(1)
    bad = bad.withColumns({"status": F.lit("LOST"), "_kafka_offset": F.lit(10**9 * 7), "_cdc_ts_ms": F.col("_cdc_ts_ms") + 1})
    land(base, {"accounts": bad})
    before = {n: content(spark, marts, n) for n in MARTS}
    with pytest.raises(QualityError, match="dim_accounts.status"):
        refresh.refresh(spark, base, marts, flagged_at=at())
    assert martstore.version(spark, marts) == now
    assert {n: content(spark, marts, n) for n in MARTS} == before
    assert martstore.drop_old_builds(spark, marts, list(MARTS)) > 0
    assert {n: content(spark, marts, n) for n in MARTS} == before


def test_two_builds_at_once(spark):
    base = fresh_path(spark, "marts")
    one, two = (martstore.Build(spark, base) for _ in range(2))
    rows = spark.range(10).withColumn("k", F.col("id").cast("string"))
    for build in (one, two):
        build.write("m", rows, "k", buckets=4)
    one.publish()
    with pytest.raises(pointer.ConflictError):
        two.publish()
    assert martstore.read_mart(spark, base, "m").count() == 10


def test_buckets_prune_and_null_keys_stay(spark):
    base = fresh_path(spark, "marts")
    build = martstore.Build(spark, base)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    build.write("m", rows, "k", buckets=16)
    build.publish()
    assert sorted(r.v for r in martstore.read_mart(spark, base, "m").collect()) == [1, 2, 3, 4]
    (bucket,) = (r[0] for r in spark.range(1).select(martstore.bucket_of(F.lit("a"), 16)).collect())
    again = martstore.Build(spark, base)
    some = again.read("m", [bucket])
    assert sorted(r.v for r in some.filter("k = 'a'").collect()) == [1, 4]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert again.read("m", []).count() == 0


def test_each_step_of_a_build_runs_once(spark, monkeypatch):
    """The gate's tests, the features and the changed transactions are read often, and computed once."""
    base, marts = (fresh_path(spark, n) for n in ("landing", "marts"))
    kept = []
    monkeypatch.setattr(refresh, "stored", lambda rows, label: kept.append(label) or stored(rows, label), raising=False)
    land(base, {n: rows.filter("_kafka_offset % 5 > 0") for n, rows in logs(spark).items()})
    refresh.full(spark, base, marts, anchor="2024-01-15", flagged_at=at(), buckets=2)
    assert kept == ["features", "tests"]
    land(base, {n: rows.filter("_kafka_offset % 5 = 0") for n, rows in logs(spark).items()})
    kept.clear()
    refresh.refresh(spark, base, marts, flagged_at=at())
    assert kept == ["changed", "features", "tests"]
