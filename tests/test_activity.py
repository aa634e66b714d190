"""Features and rules on hand-made transactions, with and without splitting of heavy accounts."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from passbook.operators.activity import FEATURES, with_activity
from passbook.operators.rules import all_flags, flags_of, union_flags, with_flag_key
from passbook.operators.skew import SkewPolicy

SCHEMA = (
    "transaction_id string, from_account_id string, from_customer_id string, amount decimal(18,2), "
    "transaction_type string, status string, created_at timestamp_ntz"
)
WHOLE = SkewPolicy()
SPLIT = SkewPolicy(min_rows=1, slot_rows=2)
POLICIES = pytest.mark.parametrize("policy", [WHOLE, SPLIT], ids=["whole", "split"])
START = datetime(2024, 3, 1, 12)


def frame(spark, rows):
    """rows: (account, time, kind, amount)"""
    return spark.createDataFrame(
        [
            (str(i), a, a, Decimal(str(x)), k, "COMPLETED", t)
            for i, (a, t, k, x) in enumerate(rows)
        ],
        SCHEMA,
    )


def rolling(spark, times, policy, kind="TRANSFER"):
    got = with_activity(frame(spark, [("a", t, kind, 1) for t in times]), policy=policy).collect()
    return [r.transfers_in_2h_window for r in sorted(got, key=lambda r: int(r.transaction_id))]


@POLICIES
def test_rolling_window_borders(spark, policy):
    two = timedelta(hours=2)
    exact = [START, START + two]
    beyond = [START, START + two + timedelta(microseconds=1)]
    assert rolling(spark, exact, policy) == [1, 2]
    assert rolling(spark, beyond, policy) == [1, 1]


@POLICIES
def test_same_instant_counts_peers(spark, policy):
    assert rolling(spark, [START, START, START + timedelta(minutes=1)], policy) == [2, 2, 3]


@POLICIES
def test_burst_across_midnight(spark, policy):
    first = datetime(2024, 3, 1, 23, 55)
    times = [first + timedelta(minutes=i) for i in range(10)]
    assert rolling(spark, times, policy) == list(range(1, 11))


@POLICIES
def test_other_kinds_do_not_count(spark, policy):
    assert rolling(spark, [START, START], policy, kind="PAYMENT") == [0, 0]


@POLICIES
def test_single_transaction(spark, policy):
    r = with_activity(frame(spark, [("a", START, "PAYMENT", "7.50")]), policy=policy).first()
    assert (r.acct_mean_amount, r.acct_stddev_amount) == (7.5, 0.0)
    assert (r.txns_on_same_day, r.avg_daily_txns) == (1, 1.0)


def expected(rows):
    """Brute force."""
    out = {}
    for i, (a, t, k, x) in enumerate(rows):
        mine = [r for r in rows if r[0] == a]
        amounts = [float(r[3]) for r in mine]
        mean = sum(amounts) / len(amounts)
        out[str(i)] = (
            round(mean, 6),
            round((sum((v - mean) ** 2 for v in amounts) / len(amounts)) ** 0.5, 6),
            sum(r[1].date() == t.date() for r in mine),
            round(len(mine) / len({r[1].date() for r in mine}), 6),
            sum(r[2] == "TRANSFER" and t - timedelta(hours=2) <= r[1] <= t for r in mine)
            if k == "TRANSFER"
            else 0,
        )
    return out


def computed(spark, rows, policy):
    got = with_activity(frame(spark, rows), policy=policy).collect()
    return {r.transaction_id: tuple(round(r[f], 6) for f in FEATURES) for r in got}


@POLICIES
def test_against_brute_force(spark, policy):
    rng = random.Random(7)
    rows = [
        (
            rng.choice("aaaab"),  # one account holds most rows
            START + timedelta(minutes=rng.randrange(3000), microseconds=rng.choice([0, 1])),
            rng.choice(["TRANSFER", "TRANSFER", "PAYMENT"]),
            rng.randrange(1, 100000) / 100,
        )
        for _ in range(300)
    ]
    assert computed(spark, rows, policy) == expected(rows)


MOMENTS = st.integers(0, 40).map(lambda n: START + timedelta(minutes=15 * n))


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.sampled_from("ab"), MOMENTS, st.sampled_from(["TRANSFER", "PAYMENT"])), min_size=1, max_size=25))
def test_split_equals_whole(spark, picks):
    rows = [(a, t, k, 1 + i) for i, (a, t, k) in enumerate(picks)]
    assert computed(spark, rows, SPLIT) == computed(spark, rows, WHOLE) == expected(rows)


@pytest.mark.parametrize("slot_rows", [1, 3, 1000])
def test_values_do_not_depend_on_the_split(spark, slot_rows):
    """Bit-equal, deviation included."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "a", "b", None]), START + timedelta(minutes=rng.randrange(9000)), rng.choice(["TRANSFER", "PAYMENT"]), rng.randrange(1, 10**7) / 100)
        for _ in range(200)
    ]
    plain, split = (
        sorted(map(repr, with_activity(frame(spark, rows), policy=p).select("transaction_id", *FEATURES).collect()))
        for p in (WHOLE, SkewPolicy(min_rows=20, slot_rows=slot_rows))
    )
    assert plain == split


def test_uneven_times_are_cut_evenly(spark):
    """Most rows within one hour of ten years."""
    from pyspark.sql import functions as F

    from passbook.operators.skew import SLOT, with_slot

    hour, years = 3_600_000_000, 10 * 365 * 24 * 3_600_000_000
    at = F.when(F.col("id") % 5 != 0, F.lit(5 * hour) + F.pmod(F.xxhash64("id"), F.lit(hour))).otherwise(F.pmod(F.xxhash64("id"), F.lit(years)))
    rows = spark.range(200_000).select(F.lit("a").alias("k"), at.alias("t"))
    slots = with_slot(rows, "k", F.col("t"), SkewPolicy(min_rows=1000, slot_rows=1000)).groupBy(SLOT).count()
    assert slots.agg({"count": "max"}).first()[0] <= 2000
    assert slots.count() >= 150


@POLICIES
def test_rules(spark, policy):
    rows = [("burst", START + timedelta(minutes=i), "TRANSFER", 10) for i in range(5)]
    rows += [("high", START + timedelta(days=i), "PAYMENT", 10) for i in range(50)]
    rows += [("high", START + timedelta(days=60), "PAYMENT", 1000)]
    rows += [("spike", START + timedelta(days=i), "PAYMENT", 10) for i in range(20)]
    rows += [("spike", START + timedelta(days=40, minutes=i), "PAYMENT", 10) for i in range(6)]
    activity = with_activity(frame(spark, rows), policy=policy)
    got = sorted((r.from_account_id, r.rule_code, r.rule_score) for r in all_flags(activity).collect())
    assert got == [
        ("burst", "BURST_TRANSFER", 5.0),
        ("high", "HIGH_VALUE_OUTLIER", round(1000 / (1500 / 51), 2)),
    ] + [("spike", "DORMANT_SPIKE", round(6 / (26 / 21), 2))] * 6
    separate = union_flags(*[flags_of(activity, c) for c in ("BURST_TRANSFER", "HIGH_VALUE_OUTLIER", "DORMANT_SPIKE")])
    assert sorted(map(repr, separate.collect())) == sorted(map(repr, all_flags(activity).collect()))
    texts = {r.rule_code: r.rule_description for r in all_flags(activity).collect()}
    assert texts == {
        "BURST_TRANSFER": "5 transfers from same account in 2-hour window",
        "HIGH_VALUE_OUTLIER": "Amount 1000.00 is 34.0x account mean (29.41)",
        "DORMANT_SPIKE": "6 transactions on this day vs avg 1.2/day",
    }


def test_exactly_three_times_the_average_is_no_spike(spark):
    # 12 rows on 4 days: average 3, busiest day 9
    rows = [("a", START, "PAYMENT", 10)] * 9
    rows += [("a", START + timedelta(days=i), "PAYMENT", 10) for i in range(1, 4)]
    assert all_flags(with_activity(frame(spark, rows)), ["DORMANT_SPIKE"]).count() == 0


def test_flag_key_and_time(spark):
    rows = [("b", START + timedelta(minutes=i), "TRANSFER", 10) for i in range(5)]
    flags = with_flag_key(all_flags(with_activity(frame(spark, rows))))
    assert flags.columns[0] == "flag_sk" and flags.columns[-1] == "flagged_at"
    assert len(flags.first().flag_sk) == 32
