import datetime as dt
import random

import pytest
from passbook.streaming import bursts
from pyspark.sql import functions as F

SCHEMA = "transaction_id string, from_account_id string, created_at timestamp_ntz, transaction_type string, status string, extra int"
START = dt.datetime(2024, 2, 28, 20, 0)


def facts(n, seed):
    """Crowded accounts, ties, window borders, a missing account, rows that do not count."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        at = START + dt.timedelta(minutes=rnd.choice([0, 30, 60, 120, rnd.randrange(900)]), microseconds=rnd.choice([0, 0, 1, 999]))
        kind = rnd.choice(["TRANSFER"] * 5 + ["PAYMENT"])
        status = rnd.choice(["COMPLETED"] * 5 + ["FAILED"])
        rows.append((f"t{k}", rnd.choice(["a", "a", "a", "b", "c", None]), at if k % 40 else None, kind, status, k))
    return rows


def brute_force(rows):
    kept = [r for r in rows if r[3] == "TRANSFER" and r[4] == "COMPLETED" and r[2] is not None]
    found = set()
    for r in kept:
        n = sum(1 for o in kept if o[1] == r[1] and r[2] - dt.timedelta(hours=2) <= o[2] <= r[2])
        if n >= 5:
            found.add((r[0], r[1], n))
    return found


def run(spark, home, parts):
    """Each part is landed and streamed by a job of its own, over one checkpoint."""
    for part in parts:
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(f"{home}/in")
        source = spark.readStream.schema(SCHEMA).parquet(f"{home}/in")
        bursts.start_flags(source, f"{home}/out", f"{home}/checkpoint", "3 hours", available_now=True).awaitTermination()
    out = spark.read.schema(bursts.FLAGS).parquet(f"{home}/out")
    return [(r.transaction_id, r.from_account_id, r.transfers_in_2h_window) for r in out.collect()]


def heartbeat(hours):
    return ("beat", "heartbeat", START + dt.timedelta(hours=hours), "TRANSFER", "COMPLETED", 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_flags_equal_batch_rule_with_restarts_and_late_rows(spark, tmp_path, seed):
    rows = facts(150, seed)
    expected = brute_force(rows)
    assert len(expected) > 20
    # rows come up to three hours late, in jobs that start again from the checkpoint
    rnd = random.Random(seed)
    order = sorted(rows, key=lambda r: (r[2] or START) + dt.timedelta(minutes=rnd.randrange(170)))
    third = len(order) // 3
    parts = [order[:third], order[third : 2 * third], [*order[2 * third :], heartbeat(40)]]
    found = run(spark, tmp_path, parts)
    assert len(found) == len(set(found)) and set(found) == expected


def test_last_hours_wait_and_old_rows_are_dropped(spark, tmp_path):
    burst = [(f"t{k}", "a", START + dt.timedelta(minutes=k), "TRANSFER", "COMPLETED", k) for k in range(6)]
    assert run(spark, tmp_path, [burst]) == []
    late = ("late", "a", START, "TRANSFER", "COMPLETED", 9)
    found = run(spark, tmp_path, [[heartbeat(9)], [late], [heartbeat(20)]])
    assert sorted(found) == [("t4", "a", 5), ("t5", "a", 6)]
    assert spark.conf.get(bursts.PROVIDER) != bursts.ROCKSDB


def test_batch_rule_agrees(spark):
    from passbook.operators import activity

    rows = [r for r in facts(200, 7) if r[4] == "COMPLETED" and r[2] is not None]
    counted = activity.rolling_count(spark.createDataFrame(rows, SCHEMA).withColumn("amount", F.lit(1).cast("decimal(18,2)")))
    batch = {(r.transaction_id, r.from_account_id, r.transfers_in_2h_window) for r in counted.collect() if r.transfers_in_2h_window >= 5}
    assert batch == brute_force(rows)


class Store:
    """Stands in for a pane's state and counts the calls that would go to the state store."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, []

    def called(self, value=None):
        self.calls += 1
        return value

    def state(self, name):
        store, values = self, self.values

        class State:
            exists = lambda _: store.called(bool(values.get(name)))
            get = lambda _: store.called(iter(values.get(name, [])) if name == "lists" else values.get(name))
            update = lambda _, v: store.called(values.update({name: v}))
            appendValue = lambda _, v: store.called(values.setdefault(name, []).append(v))
            clear = lambda _: store.called(values.pop(name, None))

        return State()

    def getListState(self, name, _):  # noqa: N802
        return self.state(name)

    getValueState = getListState  # noqa: N815

    def getMapState(self, *_):  # noqa: N802
        raise AssertionError("a call for every instant")

    def registerTimer(self, due):  # noqa: N802
        self.called(self.timers.append(due))


def test_a_pane_of_many_transfers_takes_few_calls():
    from types import SimpleNamespace

    from pyspark.sql import Row

    hours2 = 2 * 60 * 60 * 1_000_000
    store = Store()
    pane = bursts.Bursts(hours2, 5)
    pane.init(store)
    for part in range(3):
        rows = (Row(micros=1000 * k, own=True, transaction_id=f"{part}-{k}") for k in range(5000))
        assert list(pane.handleInputRows(("a", 0), rows, None)) == []
    found = []
    for now in (2500, 2 * 60 * 60 * 1000):
        found += pane.handleExpiredTimer(("a", 0), SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now), None)
    assert store.calls < 40 and not store.values
    counts = {r.transaction_id: r.transfers_in_2h_window for r in found}
    assert len(found) == len(counts) and counts == {f"{p}-{k}": 3 * (k + 1) for p in range(3) for k in range(1, 5000)}
