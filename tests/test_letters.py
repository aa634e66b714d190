"""Encrypted dead letters: sealed, replayed once the cause is mended, unreadable without their key."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from passbook.operators import connect, letters
from passbook.operators import envelope as ev
from passbook.operators.messages import drop_redelivered
from passbook.sources import landing
from passbook.sources.messages import MESSAGE_SCHEMA
from passbook.streaming.ingest import ingest_batch
from passbook.workspace import fresh_path, stored

BINARY = MESSAGE_SCHEMA.replace("value string", "value binary")
SCHEMAS = {1: "after STRUCT<customer_id: STRING, email: STRING>, op STRING, ts_ms BIGINT"}
LATER = {2: "op STRING, ts_ms BIGINT, after STRUCT<customer_id: STRING, email: STRING>"}


def body(number, name):
    text = json.dumps({"after": {"customer_id": name, "email": f"{name}@x.org"}, "op": "c", "ts_ms": 1_700_000_000_000})
    return bytearray(b"\0" + number.to_bytes(4, "big") + text.encode())


def messages(spark):
    rows = [
        ("bank.public.customers", 0, 1, body(1, "c1"), datetime(2024, 5, 6, 7)),
        ("bank.public.customers", 0, 2, body(2, "c2"), datetime(2024, 5, 6, 8)),
        ("bank.public.customers", 0, 3, body(2, "c3"), datetime(2024, 5, 7, 8)),
        ("bank.public.customers", 0, 4, bytearray(b"garbage"), datetime(2024, 5, 7, 9)),
        ("bank.public.customers", 0, 5, body(2, "c5"), None),
    ]
    return spark.createDataFrame(rows, BINARY)


def decoder(schemas):
    def run(raw, table):
        return connect.decode_registry(raw, table, schemas, lambda b, ddl: F.from_json(b.cast("string"), ddl))

    return run


def sealed(spark):
    decoded = decoder(SCHEMAS)(messages(spark), "customers")
    days = letters.missing_days(decoded, spark.createDataFrame([], "day date, letter_key binary"))
    keys = stored(letters.new_keys(days), "letter_keys")
    return decoded, keys, stored(letters.encrypted_letters(decoded, keys), "letters")


def test_letters_hold_nothing_in_the_clear(spark):
    decoded, keys, found = sealed(spark)
    assert sorted(r.offset for r in found.collect()) == [2, 3, 4, 5]
    assert keys.count() == 3 and {len(r.letter_key) for r in keys.collect()} == {32}
    assert all(r.sealed and b"@x.org" not in bytes(r.sealed) and b"garbage" not in bytes(r.sealed) for r in found.collect())
    assert letters.missing_days(decoded, keys).count() == 0
    opened = {r.offset: bytes(r.value) for r in letters.opened_letters(found, keys).collect()}
    assert opened == {r.offset: bytes(r.value) for r in messages(spark).filter("offset > 1").collect()}


def test_repaired_messages_land_once(spark):
    _, keys, found = sealed(spark)
    base = fresh_path(spark, "landing")
    ingest_batch(messages(spark), "customers", base, "s", decoder(SCHEMAS), batch="live-0")
    assert landing.scan(spark, base, "customers").count() == 1
    both = decoder(SCHEMAS | LATER)
    again = letters.replay(found, keys, both, "customers", text=False)
    assert sorted(r.offset for r in again.filter("undecodable").collect()) == [4]
    readable = letters.opened_letters(found, keys)
    for _ in range(2):
        ingest_batch(readable, "customers", base, "s", both, batch="replay-0")
    rows = landing.scan(spark, base, "customers")
    assert sorted(r.customer_id for r in rows.collect()) == ["c1", "c2", "c3", "c5"]
    ingest_batch(readable, "customers", base, "s", both, batch="replay-1")  # replayed again by mistake
    assert drop_redelivered(landing.scan(spark, base, "customers")).count() == 4


def test_a_deleted_key_makes_letters_unreadable(spark):
    _, keys, found = sealed(spark)
    left = keys.filter(F.col("day") != F.lit("2024-05-06").cast("date"))
    assert sorted(r.offset for r in letters.opened_letters(found, left).collect()) == [3, 4, 5]
    moved = found.withColumn("offset", F.col("offset") + 10)  # a letter under another position
    assert letters.opened_letters(moved, keys).count() == 0
    others = stored(letters.new_keys(keys.select("day")), "letter_keys")
    assert letters.opened_letters(found, others).count() == 0


def test_without_a_key_no_value_is_kept(spark):
    decoded = ev.decode_json(spark.createDataFrame([("t.accounts", 0, 1, "{broken", datetime(2024, 5, 6))], MESSAGE_SCHEMA), "accounts")
    none = spark.createDataFrame([], "day date, letter_key binary")
    (row,) = letters.encrypted_letters(decoded, none).collect()
    assert row.sealed is None and row.offset == 1
    assert letters.opened_letters(letters.encrypted_letters(decoded, none), none).count() == 0
