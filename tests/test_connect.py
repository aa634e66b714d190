"""Connector encodings and registry headers."""

import base64
import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.operators import connect
from passbook.operators import envelope as ev
from passbook.sources.messages import MESSAGE_SCHEMA

MONEY = T.DecimalType(18, 2)


def sent(unscaled: int, width: int | None = None) -> bytes:
    return unscaled.to_bytes(width or (unscaled.bit_length() // 8 + 1), "big", signed=True)


def messages(spark, values, table="accounts"):
    rows = [(f"bank.public.{table}", 0, i, v, datetime(2024, 5, 6)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA if isinstance(values[0], str) else MESSAGE_SCHEMA.replace("value string", "value binary"))


@pytest.mark.parametrize("n", [0, 1, -1, 127, 128, -128, -129, 255, 256, 10**18 - 1, -(10**18) + 1, 2**63, -(2**63) - 1, 10**38 - 1, -(10**38) + 1])
def test_twos_complement(spark, n):
    for raw in (sent(n), sent(n, 16)):
        row = spark.createDataFrame([(bytearray(raw),)], "b binary").select(connect.twos_complement(F.col("b"))).first()
        assert row[0] == Decimal(n)


def test_lengths_without_a_number(spark):
    rows = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\0" * 17),), (bytearray(b"\x7f" * 16),), (None,)], "b binary")
    assert [r[0] for r in rows.select(connect.twos_complement(F.col("b"))).collect()] == [None] * 4


def test_decimals_and_dates(spark):
    texts = [base64.b64encode(sent(n)).decode() for n in (1230, -5, 0, 10**18)] + ["12.3", "-7", "1e1", "x.y", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in rows.select(connect.connect_decimal(F.col("t"), MONEY)).collect()]
    d = Decimal
    assert found == [d("12.30"), d("-0.05"), d("0.00"), None, d("12.30"), d("-7.00"), d("10.00"), None, None]
    days = spark.createDataFrame([("0",), ("-1",), ("19789",), ("1980-02-03",), ("soon",), (None,)], "t string")
    found = [r[0] for r in days.select(connect.connect_date(F.col("t"))).collect()]
    assert found == [date(1970, 1, 1), date(1969, 12, 31), date(2024, 3, 7), date(1980, 2, 3), None, None]


def test_payload_bare_and_broken_messages(spark):
    account = {"account_id": "a", "balance": base64.b64encode(sent(-123456)).decode(), "status": "ACTIVE"}
    body = {"before": None, "after": account, "op": "c", "source": {"ts_ms": 7}, "ts_ms": 8}
    values = [
        json.dumps(body),
        json.dumps({"schema": {"type": "struct", "fields": []}, "payload": body}),
        json.dumps({**body, "after": {**account, "balance": "-1234.56"}}),
        json.dumps({**body, "after": {**account, "balance": "no number"}}),
        "{broken",
        "17",
    ]
    found = connect.decode_connect_json(messages(spark, values), "accounts")
    assert found.columns == [*messages(spark, values).columns, "envelope", "undecodable"]
    rows = sorted(ev.landing_rows(found, "accounts", "s").collect(), key=lambda r: r._kafka_offset)
    assert [r._kafka_offset for r in rows] == [0, 1, 2]
    assert {(str(r.balance), r._cdc_ts_ms, r._cdc_op) for r in rows} == {("-1234.56", 7, "c")}
    assert sorted(r.offset for r in ev.dead_letters(found, "s").collect()) == [3, 4, 5]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def header(number: int, body: bytes, magic: int = 0) -> bytearray:
    return bytearray(bytes([magic]) + number.to_bytes(4, "big") + body)


def test_registry_header(spark):
    raw = [header(9, b"xyz"), header(2**31 + 5, b"\0"), header(9, b"xyz", 1), bytearray(b"\0\0\0\0\7"), bytearray(b"")]
    rows = spark.createDataFrame([(r,) for r in raw], "v binary")
    found = rows.select(connect.registry_id(F.col("v")), connect.registry_body(F.col("v"))).collect()
    assert [r[0] for r in found] == [9, 2**31 + 5, None, None, None]
    assert [bytes(r[1]) for r in found] == [b"xyz", b"\0", b"xyz", b"", b""]


def test_each_message_is_read_by_its_schema(spark):
    """Writers of three versions; the first sends bytes and days, the last lacks a column and is unknown at first."""
    old = "after STRUCT<customer_id: STRING, date_of_birth: INT, email: STRING>, op STRING, ts_ms BIGINT"
    new = "ts_ms BIGINT, op STRING, after STRUCT<email: STRING, date_of_birth: DATE, customer_id: STRING, more: DOUBLE>"
    bare = "op STRING, after STRUCT<customer_id: STRING>"
    values = [
        header(1, b'{"after": {"customer_id": "c1", "date_of_birth": 1, "email": "e"}, "op": "c", "ts_ms": 5}'),
        header(2, b'{"op": "u", "after": {"customer_id": "c2", "date_of_birth": "1970-01-02", "email": "e"}, "ts_ms": 6}'),
        header(3, b'{"op": "u", "after": {"customer_id": "c3"}}'),
        header(1, b"{broken"),
        bytearray(b'{"op": "u"}'),
    ]

    def read(body, ddl):
        return F.from_json(body.cast("string"), ddl)

    raw = messages(spark, values, "customers")
    found = connect.decode_registry(raw, "customers", {1: old, 2: new}, read)
    rows = sorted(ev.landing_rows(found, "customers", "s").collect(), key=lambda r: r._kafka_offset)
    assert [r.customer_id for r in rows] == ["c1", "c2"] and rows[0].date_of_birth == rows[1].date_of_birth
    assert [r._cdc_ts_ms for r in rows] == [5, 6]
    assert sorted(r.offset for r in ev.dead_letters(found, "s").collect()) == [2, 3, 4]
    known = connect.decode_registry(raw, "customers", {1: old, 2: new, 3: bare}, read)  # once the schema is known
    assert sorted(r.customer_id for r in ev.landing_rows(known, "customers", "s").collect()) == ["c1", "c2", "c3"]


def test_bytes_become_decimals(spark):
    """What an Avro reader gives for a plain bytes field."""
    rows = spark.createDataFrame([(bytearray(header(4, sent(-250))),)], "value binary")

    def read(body, _):
        image = F.struct(F.lit("a").alias("account_id"), body.alias("balance"))
        return F.struct(image.alias("after"), F.lit("c").alias("op"))

    found = connect.decode_registry(rows, "accounts", {4: ""}, read)
    assert str(found.first().envelope.after.balance) == "-2.50"
