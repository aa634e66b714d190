"""Data tests, gate, full rebuild, retention, keyed tokens, calendar, scalars."""

import hashlib
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from passbook import fixtures as fx
from passbook.functions import scalars as sc
from passbook.operators import envelope, governance, quality
from passbook.plans import anomaly, build
from passbook.plans.expectations import MODEL_TESTS
from passbook.sources import landing
from passbook.sources.calendar import dim_date
from passbook.workspace import fresh_path

SF = "/root/testdata/sf0.001"


def results(spark, rows, tests):
    return {
        (r["column"], r.test): r.failing_rows
        for r in quality.run_expectations("m", rows, tests).collect()
    }


def test_expectations_count_failures(spark):
    rows = spark.createDataFrame(
        [("a", 1, True), ("a", None, False), (None, -3, None), (None, 4, True)],
        "k string, n int, b boolean",
    )
    tests = quality.not_null("k", "n") + quality.unique("k")
    tests += quality.accepted_values("k", ["b"]) + quality.accepted_values("b", [True, False])
    tests += quality.check("n", "n > 0")
    assert results(spark, rows, tests) == {
        ("k", "not_null"): 2,
        ("n", "not_null"): 1,
        ("k", "unique"): 1,
        ("k", "accepted_values"): 2,
        ("b", "accepted_values"): 0,
        ("n", "expression_is_true"): 1,
    }


def test_row_tests_share_one_scan(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet")
    tests = quality.not_null(*rows.columns)
    plan = quality.run_expectations("m", rows, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_gate_stops_on_errors_only(spark):
    rows = spark.createDataFrame([(None,)], "k string")
    warned = quality.run_expectations("m", rows, quality.not_null("k", severity="warn"))
    assert quality.gate(warned).count() == 1
    with pytest.raises(quality.QualityError, match="m.k not_null: 1"):
        quality.gate(quality.run_expectations("m", rows, quality.not_null("k")))


def test_referential(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert quality.referential("c", child, "fk", parent, "id").first().failing_rows == 2


def test_there_are_67_model_tests():
    kinds = [e.test for tests in MODEL_TESTS.values() for e in tests]
    assert len(kinds) == 67
    assert [kinds.count(k) for k in ("not_null", "unique", "accepted_values")] == [52, 7, 8]


@pytest.fixture(scope="module")
def landed(spark):
    base = fresh_path(spark, "landing")
    logs = {
        "customers": fx.customer_log(spark, SF),
        "accounts": fx.account_log(spark, SF),
        "transactions": fx.transaction_log(spark, SF),
    }
    for name, rows in logs.items():
        # one folder per day keeps the test quick; the layout is otherwise the real one
        stamped = envelope.with_partitions(rows).withColumn("hour", F.lit("00"))
        if name == "customers":
            stamped = stamped.withColumns({"month": F.lit("01"), "day": F.lit("01")})
        landing.write_rows(stamped, base, name)
    return base


def test_rebuild_passes_all_tests(spark, landed):
    marts = fresh_path(spark, "marts")
    outcome = build.rebuild(spark, landed, marts, anchor="2024-01-15")
    assert outcome.count() == 67
    assert outcome.filter("failing_rows > 0").count() == 0
    for name in build.TABLES:
        assert build.read_mart(spark, marts, name).count() > 0
    versions = build.read_mart(spark, marts, "dim_accounts")
    assert versions.count() == 872 and versions.filter("is_current").count() == 15
    # again, as a full overwrite, with staging and features as views
    again = build.rebuild(spark, landed, marts, anchor="2024-01-15", view=build.as_view)
    assert again.count() == 67
    assert spark.table("stg_accounts").count() > 0
    assert build.read_mart(spark, marts, "dim_accounts").count() == 872


def test_rebuild_fails_on_bad_data(spark, landed):
    good = landing.scan(spark, landed, "accounts").filter("_cdc_op <> 'd'").dropDuplicates(["_kafka_offset"])
    bad = good.orderBy("_kafka_offset").limit(5).withColumn("status", F.lit("LOST"))
    bad = bad.withColumn("_kafka_offset", F.col("_kafka_offset") + 10**6)
    sources = {t: landing.scan(spark, landed, t) for t in ("customers", "transactions")}
    sources["accounts"] = landing.scan(spark, landed, "accounts").unionByName(bad)
    models = build.build_models(sources, dim_date(spark, "2024-01-15"), table=build.as_view)
    from passbook.plans.expectations import test_models

    with pytest.raises(quality.QualityError, match="stg_accounts.status accepted_values: 5"):
        quality.gate(test_models({"stg_accounts": models["stg_accounts"]}))


def test_late_events_are_absorbed(spark):
    """A rebuild orders all history again, so arrival order does not matter."""
    from passbook.plans import marts, staging

    log = fx.account_log(spark, SF)
    early, late = log.filter("_kafka_offset % 2 = 0"), log.filter("_kafka_offset % 2 = 1")
    whole, shuffled = (
        sorted(map(repr, marts.dim_accounts(staging.stg_accounts(rows)).collect()))
        for rows in (log, late.unionByName(early))
    )
    assert len(whole) == 872 and whole == shuffled


def test_flagged_at_defaults_to_now(spark):
    flags = anomaly.mart_suspicious_transactions(fx.facts(spark, SF))
    assert flags.filter("flagged_at IS NULL").count() == 0 and flags.count() == 6


def test_unknown_account_keeps_null_owner(spark):
    from passbook.plans import marts, staging

    fact = marts.fact_transactions(
        staging.stg_transactions(fx.transaction_log(spark, SF)),
        marts.dim_accounts(staging.stg_accounts(fx.account_log(spark, SF).filter("account_id = '1'"))),
    )
    owners = fact.groupBy((F.col("from_account_id") == "1").alias("known")).agg(F.count("from_customer_id").alias("n"))
    found = {r.known: r.n for r in owners.collect()}
    assert found[False] == 0 and found[True] > 0


def test_retention_keeps_the_limit_day(spark):
    rows = spark.createDataFrame([(date(2024, 1, 1),), (date(2023, 12, 31),)], "day date")
    kept = governance.keep_within(rows, F.col("day"), "2024-03-31", 90)
    assert [r.day for r in kept.collect()] == [date(2024, 1, 1)]
    report = governance.retention_report(rows, "x", F.col("day"), "2024-03-31", 90).first()
    assert (report.rows_kept, report.rows_expired, report.oldest_day) == (1, 1, date(2023, 12, 31))


def _has_files(base, day):
    return any(f.endswith(".parquet") for path, _, files in os.walk(base) if f"/{day}" in path for f in files)


def test_expire_removes_whole_days_once(spark, landed):
    base = fresh_path(spark, "expire")
    landing.write_rows(landing.scan(spark, landed, "accounts"), base, "accounts")
    landing.close_hours(spark, base, "accounts")
    folders = governance.expired_folders(spark, base, "accounts", "2024-01-20", days=5)
    assert {r.day for r in folders.collect()} == {f"{d:02d}" for d in range(1, 15)}
    assert governance.expire(spark, base, "accounts", "2024-01-20", days=5) == 14
    assert governance.expire(spark, base, "accounts", "2024-01-20", days=5) == 0
    left = landing.scan(spark, base, "accounts").agg(F.min("day")).first()[0]
    assert left == "15"
    days = [name for _, folders, _ in os.walk(base) for name in folders if name.startswith("day=")]
    assert {name for name in days if _has_files(base, name)} == {name for name in days if name >= "day=15"}


def test_policy_table(spark):
    rows = {r.dataset: (r.keep_days, r.keep_ms) for r in governance.retention_policy(spark).collect()}
    assert rows == {
        "transactions": (2555, 220_752_000_000),
        "accounts": (2555, 220_752_000_000),
        "customers": (90, 7_776_000_000),
    }


def test_keyed_tokens(spark):
    rows = spark.createDataFrame([(1, "Ann"), (2, "Bob")], "id int, name string")
    keys = spark.createDataFrame([(1, "k1")], "id int, token_key string")
    found = dict(governance.keyed_tokens(rows, keys, "id", ["name"]).collect())
    assert found == {1: hashlib.sha256(b"k1:Ann").hexdigest(), 2: None}


def test_calendar(spark):
    days = dim_date(spark, "2024-02-29")
    assert days.count() == (date(2027, 2, 28) - date(2022, 2, 28)).days
    r = days.filter("date_id = 20240302").first()
    assert (r.day_of_week, r.day_name, r.month_name, r.quarter, r.is_weekend) == (6, "Saturday", "March", 1, True)
    assert days.filter("day_name = 'Sunday'").select("day_of_week").distinct().collect() == [(0,)]


def test_scalars(spark):
    row = spark.range(1).select(
        sc.round_double(F.lit(1.005), 2).alias("a"),
        sc.double_text(F.lit(12345678.5), 1).alias("b"),
        sc.double_text(F.lit(59.1), 2).alias("c"),
        sc.double_text(F.lit(7.0), 2).alias("d"),
        sc.md5_key(F.lit("x"), F.lit(5)).alias("e"),
        sc.text_token(F.lit(None).cast("string"), "s").alias("f"),
        sc.iso_to_utc(F.lit("2024-01-01T10:00:00.5Z")).alias("g"),
        sc.last_segment(F.lit("bank.public.accounts")).alias("h"),
    ).first()
    assert row[:4] == (1.0, "12345678.5", "59.1", "7.0")
    assert row.e == hashlib.md5(b"x|5").hexdigest()
    assert row.f is None and row.g == datetime(2024, 1, 1, 10, 0, 0, 500000) and row.h == "accounts"


def test_intermediate_tables_have_an_owner(spark):
    import os

    from passbook.workspace import shared_folder, stored, temporary_tables

    kept = stored(spark.range(3), "kept")
    with temporary_tables(spark):
        inner = stored(spark.range(5), "inner")
        assert inner.count() == 5
    folder = shared_folder(spark).removeprefix("file:")
    assert not [n for n in os.listdir(folder) if n.startswith("inner-")]
    assert kept.count() == 3
