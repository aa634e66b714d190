"""Messages → landing rows: decode, tokens, flatten, partitions, sinks, streaming."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from passbook.contracts import landing_schema
from passbook.operators import envelope as ev
from passbook.operators.messages import drop_redelivered, earliest_per_key, latest_per_key
from passbook.sources import landing
from passbook.sources.messages import MESSAGE_SCHEMA, file_stream, kafka_options
from passbook.streaming.ingest import DEAD_LETTERS, dedup_stream, ingest_batch, start_all, start_ingest
from passbook.workspace import fresh_path

SALT = "pepper"


def customer(**changes):
    row = {
        "customer_id": "c1",
        "first_name": "Ann",
        "last_name": None,
        "email": "a@x.org",
        "national_id": "123",
        "date_of_birth": "1980-02-03",
        "created_at": "2024-01-01T00:00:00Z",
        "updated_at": "2024-01-01T00:00:00Z",
    }
    return {**row, **changes}


def account(**changes):
    row = {
        "account_id": "a1",
        "customer_id": "c1",
        "account_number": "DE1",
        "account_type": "CHECKING",
        "currency": "EUR",
        "balance": "12.30",
        "status": "ACTIVE",
        "created_at": "t0",
        "updated_at": "t1",
    }
    return {**row, **changes}


def envelope(after=None, before=None, op="u", source=1_700_000_000_000, ts=5, **extra):
    body = {"before": before, "after": after, "op": op, "source": {"ts_ms": source}, "ts_ms": ts}
    return json.dumps({**body, **extra})


def messages(spark, values, table="customers"):
    arrived = datetime(2024, 5, 6, 7, 8)
    rows = [(f"bank.public.{table}", 0, i, v, arrived) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def decoded(spark, values, table="customers"):
    return ev.decode_json(ev.drop_tombstones(messages(spark, values, table)), table)


def rows_of(spark, values, table="customers"):
    rows = ev.landing_rows(decoded(spark, values, table), table, SALT).collect()
    return sorted(rows, key=lambda r: r._kafka_offset)


def token(value):
    return hashlib.sha256(f"{SALT}:{value}".encode()).hexdigest()


def test_table_name(spark):
    names = ev.with_table_name(messages(spark, ["x"], "accounts")).first()
    assert names["table"] == "accounts"
    assert ev.of_table(messages(spark, ["x"], "accounts"), "customers").count() == 0


def test_tombstones_and_dead_letters(spark):
    values = [None, "{broken", "17", '{"after": {"date_of_birth": "no date"}}', envelope(customer())]
    found = decoded(spark, values)
    assert found.count() == 4
    assert sorted(r.offset for r in ev.dead_letters(found, SALT).collect()) == [1, 2, 3]
    assert [r.offset for r in ev.decoded_only(found).collect()] == [4]


def test_tokens_in_both_images_and_in_the_before_text(spark):
    (row,) = rows_of(spark, [envelope(customer(), customer(first_name="Old"))])
    assert row.first_name == token("Ann")
    assert row.date_of_birth == token("1980-02-03")
    assert row.last_name is None  # null stays null
    before = json.loads(row._cdc_before)
    assert before["first_name"] == token("Old") and before["last_name"] is None
    assert "Old" not in row._cdc_before and "a@x.org" not in row._cdc_before


def test_tables_without_policy_pass(spark):
    t = {"transaction_id": "t", "from_account_id": "a", "amount": 5.25, "created_at": "x"}
    (row,) = rows_of(spark, [envelope(t, op="c")], "transactions")
    assert (row.from_account_id, str(row.amount), row.description) == ("a", "5.25", None)


def test_delete_uses_before_image(spark):
    values = [envelope(None, account(), "d"), envelope({}, account(balance="1.00"), "d")]
    first, second = rows_of(spark, values, "accounts")
    assert (first.account_id, str(first.balance), first._cdc_op) == ("a1", "12.30", "d")
    assert str(second.balance) == "1.00"  # an empty after image counts as absent
    before = json.loads(first._cdc_before)
    assert before["balance"] == "12.30" and before["account_number"] == token("DE1")


def test_insert_has_no_before(spark):
    (row,) = rows_of(spark, [envelope(account(), op="c")], "accounts")
    assert row._cdc_before is None


def test_missing_operation_is_empty_text(spark):
    body = {"after": account(), "source": {"ts_ms": 1}, "ts_ms": 1}
    (row,) = rows_of(spark, [json.dumps(body)], "accounts")
    assert row._cdc_op == ""


@pytest.mark.parametrize(
    "source, ts, expected",
    [(7, 5, 7), (0, 5, 5), (None, 5, 5), (None, None, None), (0, 0, 0)],
)
def test_event_time(spark, source, ts, expected):
    (row,) = rows_of(spark, [envelope(account(), source=source, ts=ts)], "accounts")
    assert row._cdc_ts_ms == expected
    if expected:
        assert (row.year, row.month, row.day, row.hour) == ("1970", "01", "01", "00")
    else:
        assert (row.year, row.month, row.day, row.hour) == ("2024", "05", "06", "07")  # arrival, also on a replay


def test_partition_hours(spark):
    at = 1_709_251_199_999  # 2024-02-29 23:59:59.999 UTC
    (row,) = rows_of(spark, [envelope(account(), source=at)], "accounts")
    assert (row.year, row.month, row.day, row.hour) == ("2024", "02", "29", "23")


def account_messages(spark, n=40):
    hour = 3_600_000
    values = [
        envelope(account(account_id=f"a{i % 5}", balance=f"{i}.00"), source=1_700_000_000_000 + i * hour)
        for i in range(n)
    ]
    return messages(spark, values + [None, "{broken"], "accounts")


def plain(df):
    columns = sorted(c for c in df.columns if c != "batch")
    return sorted(map(repr, df.select(*columns).collect()))


def test_batch_and_stream_land_the_same(spark):
    base = fresh_path(spark, "t")
    raw = account_messages(spark)
    ingest_batch(raw, "accounts", f"{base}/batch", SALT)
    raw.repartition(4).write.parquet(f"{base}/messages")
    job = start_ingest(
        file_stream(spark, f"{base}/messages", 1),
        "accounts",
        f"{base}/stream",
        f"{base}/checkpoint",
        SALT,
        "s",
        available_now=True,
    )
    job.awaitTermination()
    assert len(job.recentProgress) >= 4  # several micro-batches
    one, two = (landing.scan(spark, f"{base}/{k}", "accounts") for k in ("batch", "stream"))
    assert one.count() == 40 and plain(one) == plain(two)
    assert one.schema == landing_schema("accounts")
    for kind in ("batch", "stream"):
        bad = spark.read.parquet(f"{base}/{kind}/{DEAD_LETTERS}/accounts")
        assert [(r["value_length"], r["value_token"]) for r in bad.collect()] == [(7, token("{broken"))]


def test_replayed_batch_adds_nothing(spark):
    base = fresh_path(spark, "t")
    rows = ev.landing_rows(ev.decode_json(ev.drop_tombstones(account_messages(spark)), "accounts"), "accounts", SALT)
    landing.write_rows(rows, base, "accounts", "s-0")
    landing.write_rows(rows, base, "accounts", "s-0")
    assert landing.scan(spark, base, "accounts").count() == 40
    landing.write_rows(rows, base, "accounts")  # another delivery of the same messages
    again = landing.scan(spark, base, "accounts")
    assert again.count() == 80
    assert drop_redelivered(again).count() == 40


def test_kafka_options_hold_nothing_back():
    options = kafka_options("host:1", "bank.public.accounts")
    assert options["minOffsetsPerTrigger"] == "5000" and options["maxTriggerDelay"] == "60s"
    assert "maxOffsetsPerTrigger" not in options
    assert kafka_options("h", "t", max_messages=7)["maxOffsetsPerTrigger"] == "7"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    from passbook.functions.scalars import date_key, millis_to_utc, utc_micros

    at = 1_710_054_600_000  # 2024-03-10 07:10 UTC; 02:30 that day does not exist in New York
    rows = spark.createDataFrame([(at,), (1_710_037_800_000,), (0,), (-1,)], "ms bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        ntz = millis_to_utc(F.col("ms"))
        found = rows.select("ms", ntz.cast("string").alias("text"), utc_micros(ntz).alias("us"), date_key(ntz).alias("day")).collect()
        hours = ev.with_partitions(rows.withColumnRenamed("ms", "_cdc_ts_ms")).filter("_cdc_ts_ms > 0").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.us for r in found] == [r.ms * 1000 for r in found]
    assert [r.text for r in found] == ["2024-03-10 07:10:00", "2024-03-10 02:30:00", "1970-01-01 00:00:00", "1969-12-31 23:59:59.999"]
    assert [r.day for r in found] == [20240310, 20240310, 19700101, 19691231]
    assert [(r.day, r.hour) for r in hours] == [("10", "07"), ("10", "02")]


def test_tokens_under_a_key_per_person(spark):
    values = [envelope(customer(customer_id=f"c{k}")) for k in (1, 2)] + [envelope(None, customer(customer_id="c1"), "d")]
    keys = spark.createDataFrame([("c1", "k1"), ("c9", "k9")], "customer_id string, token_key string")
    rows = ev.landing_rows(decoded(spark, values), "customers", SALT, keys).collect()
    own = hashlib.sha256(b"k1:Ann").hexdigest()
    found = {(r.customer_id, r._cdc_op): r.first_name for r in rows}
    assert found == {("c1", "u"): own, ("c2", "u"): None, ("c1", "d"): own}  # no key, no token
    assert "Ann" not in str(rows)
    payment = {"transaction_id": "t", "from_account_id": "a", "amount": 5.25, "created_at": "x"}
    moved = ev.landing_rows(decoded(spark, [envelope(payment, op="c")], "transactions"), "transactions", SALT, keys)
    assert moved.count() == 1 and moved.schema.names == landing_schema("transactions").names


def test_one_call_streams_all_tables(spark):
    base = fresh_path(spark, "t")
    account_messages(spark).unionByName(messages(spark, [envelope(customer())])).write.parquet(f"{base}/messages")
    jobs = start_all(
        lambda table: file_stream(spark, f"{base}/messages"), f"{base}/landing", f"{base}/checkpoints", SALT, "s",
        tables=("accounts", "customers"), available_now=True,
    )
    for job in jobs.values():
        job.awaitTermination()
    counts = {t: landing.scan(spark, f"{base}/landing", t).count() for t in jobs}
    assert counts == {"accounts": 40, "customers": 1}


def test_stream_dedup(spark):
    base = fresh_path(spark, "t")
    rows = ev.landing_rows(ev.decode_json(ev.drop_tombstones(account_messages(spark, 5)), "accounts"), "accounts", SALT)
    rows.unionByName(rows).write.parquet(f"{base}/rows")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/rows")
    job = (
        dedup_stream(stream, "2 hours")
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 5


def log(spark, rows):
    return spark.createDataFrame(
        rows, "k string, v int, _cdc_op string, _cdc_ts_ms bigint, _kafka_partition int, _kafka_offset bigint"
    )


def test_latest_and_earliest(spark):
    rows = log(
        spark,
        [
            ("a", 1, "c", 10, 0, 1),
            ("a", 2, "u", 20, 0, 2),
            ("a", 3, "u", 20, 0, 3),  # same time, later position
            ("a", 3, "u", 20, 0, 3),  # delivered twice
            ("b", 4, "c", 10, 0, 4),
            ("b", 5, "d", 30, 0, 5),
            ("c", 6, None, 10, 0, 6),  # unknown operation: neither kept nor deleted
        ],
    )
    assert {r.k: r.v for r in latest_per_key(rows, ["k"]).collect()} == {"a": 3, "b": 4}
    erased = latest_per_key(rows, ["k"], drop_deleted=True)
    assert {r.k: r.v for r in erased.collect()} == {"a": 3}
    assert {r.k: r.v for r in earliest_per_key(rows, ["k"]).collect()} == {"a": 1, "b": 4}


def test_latest_limits_groups_before_the_shuffle(spark):
    rows = log(spark, [("a", 1, "c", 10, 0, 1)])
    plan = latest_per_key(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reconcile_foreign_files(spark, tmp_path):
    import decimal

    import pyarrow as pa
    import pyarrow.parquet as pq

    def write(name, **columns):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")

    d = decimal.Decimal
    write("a", transaction_id=["1"], amount=pa.array([d("1.5")], pa.decimal128(3, 1)), description=pa.nulls(1))
    write("b", transaction_id=["2"], amount=pa.array([d("22.25")], pa.decimal128(9, 2)), description=["x"])
    write("c", amount=pa.array([d("3.1250")], pa.decimal128(9, 4)), transaction_id=["3"])
    write("e", amount=pa.array([7], pa.int32()), transaction_id=["4"])
    write("f", amount=pa.array([10**17 * 1.0], pa.float64()), transaction_id=["5"])  # out of range
    write("g", amount=pa.array([d("8.50")], pa.decimal128(9, 2)), description=["y"], transaction_id=["6"])
    contract = landing_schema("transactions", with_partitions=False)
    rows = landing.reconcile(spark, str(tmp_path), contract)
    assert rows.schema.names == contract.names
    found = {r.transaction_id: (str(r.amount), r.description) for r in rows.collect()}
    expected = {"1": ("1.50", None), "2": ("22.25", "x"), "3": ("3.13", None), "4": ("7.00", None), "5": ("None", None), "6": ("8.50", "y")}
    assert found == expected
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert dict(rows.dtypes)["amount"] == "decimal(18,2)"


def test_hot_message_copies_collapse_before_the_shuffle(spark):
    rows = log(spark, [("a", 1, "c", 10, 0, 1)]).crossJoin(spark.range(5000)).drop("id")
    deduped = drop_redelivered(rows)
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") == 2  # partial and final
    assert deduped.count() == 1


def test_keyless_columns_policy(spark):
    rows = spark.createDataFrame([("x", "y")], "first_name string, other string")
    hidden = ev.hide_personal_columns(rows, "customers", SALT).first()
    assert hidden == (token("x"), "y")
    same = ev.hide_personal_columns(rows, "transactions", SALT).first()
    assert same == ("x", "y")
    custom = ev.hide_personal_columns(rows, "t", SALT, {"t": ["other"]}).select(F.col("other")).first()
    assert custom.other == token("y")


def test_a_batch_of_one_part_is_decoded_by_all_cores(spark, tmp_path):
    from pathlib import Path

    import pyarrow.parquet as pq
    from passbook.streaming import ingest

    value = '{"after": {"account_id": "7"}, "op": "c", "ts_ms": 1704067200000, "source": {"ts_ms": 1704067200000}}'
    rows = spark.range(0, 800, 1, 1).select(
        F.lit("bank.public.accounts").alias("topic"), F.lit(0).alias("partition"), (F.col("id") % 2).alias("offset"), F.lit(value).alias("value")
    )
    ingest.ingest_batch(rows, "accounts", str(tmp_path), "salt", batch="s-0")
    files = [pq.ParquetFile(p).metadata.num_rows for p in Path(tmp_path, "accounts/open").rglob("*.parquet")]
    # copies of a message are dealt out like others
    assert sum(files) == 800 and len(files) > 1
    assert ingest.spread(rows).rdd.glom().map(len).collect() == pytest.approx([100] * 8, abs=60)
