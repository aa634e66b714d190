"""Change points, versions and as-of lookup on hand-made logs."""

from datetime import datetime
from decimal import Decimal

import pytest

from passbook.operators.history import as_of, change_points, version_intervals
from passbook.operators.skew import SLOT, SkewPolicy
from passbook.plans import marts, staging

LOG = (
    "account_id string, balance decimal(18,2), status string, _cdc_ts_ms bigint, "
    "_kafka_partition int, _kafka_offset bigint"
)
WHOLE = SkewPolicy()
SPLIT = SkewPolicy(min_rows=1, slot_rows=1)
POLICIES = pytest.mark.parametrize("policy", [WHOLE, SPLIT], ids=["whole", "split"])


def log(spark, rows):
    return spark.createDataFrame(
        [(a, None if b is None else Decimal(b), s, t, 0, o) for a, b, s, t, o in rows], LOG
    )


def changed_offsets(spark, rows, policy):
    return sorted(r._kafka_offset for r in change_points(log(spark, rows), policy=policy).collect())


@POLICIES
def test_only_tracked_changes_count(spark, policy):
    rows = [
        ("a", 10, "ACTIVE", 1, 1),
        ("a", 10, "ACTIVE", 2, 2),  # nothing moved
        ("a", 20, "ACTIVE", 3, 3),
        ("a", 20, "FROZEN", 4, 4),
        ("b", 20, "FROZEN", 5, 5),
    ]
    assert changed_offsets(spark, rows, policy) == [1, 3, 4, 5]


@POLICIES
def test_back_and_forth_gives_three(spark, policy):
    rows = [("a", b, "ACTIVE", t, t) for t, b in enumerate([1, 2, 1], start=1)]
    assert changed_offsets(spark, rows, policy) == [1, 2, 3]


@POLICIES
def test_null_balances(spark, policy):
    rows = [
        ("a", 1, "ACTIVE", 1, 1),
        ("a", None, "ACTIVE", 2, 2),  # null against 1 is no difference
        ("a", None, "ACTIVE", 3, 3),  # previous balance null counts as first event
        ("a", None, "FROZEN", 4, 4),
    ]
    assert changed_offsets(spark, rows, policy) == [1, 3, 4]


@POLICIES
def test_same_millisecond_ordered_by_position(spark, policy):
    rows = [("a", 2, "ACTIVE", 5, 11), ("a", 1, "ACTIVE", 5, 10), ("a", 2, "ACTIVE", 6, 12)]
    assert changed_offsets(spark, rows, policy) == [10, 11]


def versions(spark, rows, policy=WHOLE):
    changes = change_points(log(spark, rows), policy=policy, keep_slot=True)
    return version_intervals(changes.withColumnRenamed("_cdc_ts_ms", "change_ts_ms"), policy=policy)


@POLICIES
def test_versions_are_gapless(spark, policy):
    rows = [("a", t % 5, "ACTIVE", 1000 * t, t) for t in range(1, 40)]
    rows += [("b", 1, "ACTIVE", 7000, 100)]
    got = sorted(versions(spark, rows, policy).collect(), key=lambda r: (r.account_id, r.version_number))
    a = [r for r in got if r.account_id == "a"]
    assert [r.version_number for r in a] == list(range(1, 40))
    assert all(x.valid_to == y.valid_from for x, y in zip(a, a[1:]))
    assert [r.is_current for r in a] == [False] * 38 + [True]
    assert a[-1].valid_to is None
    assert [(r.version_number, r.is_current) for r in got if r.account_id == "b"] == [(1, True)]


def test_surrogate_key_collides_within_one_millisecond(spark):
    got = versions(spark, [("a", 1, "ACTIVE", 5, 1), ("a", 2, "ACTIVE", 5, 2)]).collect()
    assert len(got) == 2 and len({r.account_sk for r in got}) == 1


@POLICIES
def test_as_of_is_half_open(spark, policy):
    held = versions(
        spark, [("a", 1, "ACTIVE", 1000, 1), ("a", 2, "ACTIVE", 2000, 2), ("a", 3, "ACTIVE", 2000, 3)]
    )
    at = [datetime(1970, 1, 1, 0, 0, s, us) for s, us in [(0, 0), (1, 0), (1, 999999), (2, 0), (9, 0)]]
    facts = spark.createDataFrame(
        [(i, "a", t) for i, t in enumerate(at)] + [(9, "nobody", at[-1])],
        "id int, account string, happened timestamp_ntz",
    )
    got = as_of(facts, held, "account", "happened", ["balance", "version_number"], policy=policy)
    found = {r.id: None if r.balance is None else int(r.balance) for r in got.collect()}
    assert found == {0: None, 1: 1, 2: 1, 3: 3, 4: 3, 9: None}


@POLICIES
def test_as_of_skips_closed_versions(spark, policy):
    held = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), datetime(2024, 1, 5), 1, "x")],
        "account_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, version_number int, label string",
    )
    facts = spark.createDataFrame(
        [("a", datetime(2024, 1, 4)), ("a", datetime(2024, 1, 5))], "account string, at timestamp_ntz"
    )
    got = as_of(facts, held, "account", "at", ["label"], policy=policy).collect()
    assert {r["at"].day: r.label for r in got} == {4: "x", 5: None}


def test_split_slots_are_many(spark):
    rows = [("a", t % 5, "ACTIVE", 1000 * t, t) for t in range(1, 40)]
    slots = change_points(log(spark, rows), policy=SPLIT, keep_slot=True).select(SLOT).distinct()
    assert slots.count() > 20


@POLICIES
def test_deleted_and_redelivered_accounts(spark, policy):
    image = ("c1", "tok", "CHECKING", "EUR", Decimal("5.00"), "ACTIVE", "t0", "t1")
    def row(op, ts, offset):
        return ("a", *image, op, ts, None, "bank.public.accounts", 0, offset)
    landing = spark.createDataFrame(
        [row("c", 1, 1), row("c", 1, 1), row("d", 2, 2)],
        "account_id string, customer_id string, account_number string, account_type string, "
        "currency string, balance decimal(18,2), status string, created_at string, updated_at string, "
        "_cdc_op string, _cdc_ts_ms bigint, _cdc_before string, _kafka_topic string, "
        "_kafka_partition int, _kafka_offset bigint",
    )
    dim = marts.dim_accounts(staging.stg_accounts(landing, policy), policy=policy).collect()
    assert [(r.version_number, r.is_current) for r in dim] == [(1, True)]


def test_stray_times_do_not_spoil_the_slots(spark):
    rows = [("a", t % 5, "ACTIVE", 10**12 + t, t) for t in range(1, 400)]
    rows += [("a", 9, "ACTIVE", 0, 1000), ("a", 9, "ACTIVE", 10**14, 1001)]
    policy = SkewPolicy(min_rows=10, slot_rows=20)
    slots = change_points(log(spark, rows), policy=policy, keep_slot=True).groupBy(SLOT).count()
    assert slots.agg({"count": "max"}).first()[0] <= 40
    assert changed_offsets(spark, rows, policy) == changed_offsets(spark, rows, WHOLE)


def test_account_log_crosses_the_network_once(spark):
    import spark_queries

    plan = spark_queries.QUERIES["scd2_accounts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan


@POLICIES
def test_copies_are_no_changes(spark, policy):
    rows = [("a", t % 3, "ACTIVE", 1000 * t, t) for t in range(1, 12)]
    twice = [r for r in rows for _ in range(1 + r[4] % 3)]
    assert changed_offsets(spark, twice, policy) == changed_offsets(spark, rows, WHOLE)


@POLICIES
def test_facts_without_key_stay_without_version(spark, policy):
    held = versions(spark, [("a", 1, "ACTIVE", 1000, 1)], policy)
    facts = spark.createDataFrame([(1, None, datetime(2024, 1, 1)), (2, "a", datetime(2024, 1, 1))], "id int, account string, at timestamp_ntz")
    found = as_of(facts, held, "account", "at", ["balance"], policy=policy).collect()
    assert {r.id: r.balance is None for r in found} == {1: True, 2: False}
