"""Ledger-shaped views over the test tables, which hold no ledger.

``events`` plays the account log and the transactions, ``orders`` with ``customer`` the customer
log. ``oracle_queries.py`` defines the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.contracts import ACCOUNT_TYPES, CURRENCIES
from passbook.functions.scalars import date_key, utc_micros
from passbook.operators.envelope import hide_personal_columns

SALT = "test-salt"
TOPIC_PREFIX = "bank.public"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: Column) -> Column:
    return F.floor(utc_micros(ts) / 1000).cast("bigint")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _lineage(topic: str, op: Column, ts_ms: Column, partition: Column, offset: Column) -> list[Column]:
    return [
        op.alias("_cdc_op"),
        ts_ms.alias("_cdc_ts_ms"),
        F.lit(None).cast("string").alias("_cdc_before"),
        F.lit(f"{TOPIC_PREFIX}.{topic}").alias("_kafka_topic"),
        partition.cast("int").alias("_kafka_partition"),
        offset.cast("bigint").alias("_kafka_offset"),
    ]


def account_images(events: DataFrame) -> DataFrame:
    """One account state per event, personal data in the clear, plus the event's own columns."""
    user = F.col("user_id")
    kind = F.col("event_type")
    return events.select(
        user.cast("string").alias("account_id"),
        user.cast("string").alias("customer_id"),
        F.concat(F.lit("AC"), F.lpad(user.cast("string"), 10, "0")).alias("account_number"),
        _pick(ACCOUNT_TYPES, user).alias("account_type"),
        _pick(CURRENCIES, user).alias("currency"),
        (F.floor(F.col("value") / 25) * 25).cast("decimal(18,2)").alias("balance"),
        F.when(kind == "error", "FROZEN")
        .when(kind == "signup", "CLOSED")
        .otherwise("ACTIVE")
        .alias("status"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.date_format("ts", ISO).alias("updated_at"),
        "event_id",
        "user_id",
        "ts",
    )


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of ``accounts``: changes, deletes, re-delivered copies."""
    images = account_images(table(spark, sf_dir, "events"))
    log = hide_personal_columns(images, "accounts", SALT).select(
        *[c for c in images.columns if c not in ("event_id", "user_id", "ts")],
        *_lineage(
            "accounts",
            F.when(F.col("event_id") % 50 == 0, "d").otherwise("u"),
            millis(F.col("ts")),
            F.col("user_id") % 3,
            F.col("event_id"),
        ),
    )
    return log.unionByName(log.filter(F.col("_kafka_offset") % 7 == 0))


def transaction_images(events: DataFrame, account: Column | None = None) -> DataFrame:
    source = F.col("user_id") if account is None else account
    transfer = F.col("event_type").isin("click", "purchase")
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        source.cast("string").alias("from_account_id"),
        F.when(transfer, (F.col("user_id") + 1).cast("string")).alias("to_account_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.lit("EUR").alias("currency"),
        F.when(transfer, "TRANSFER").otherwise("PAYMENT").alias("transaction_type"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        F.lit(None).cast("string").alias("description"),
        "ts",
        "event_id",
    )


def transaction_log(
    spark: SparkSession, sf_dir: str, account: Column | None = None
) -> DataFrame:
    """Landing rows of ``transactions``: inserts, re-delivered copies, later updates."""
    images = transaction_images(table(spark, sf_dir, "events"), account)
    created = images.select(
        *[c for c in images.columns if c not in ("ts", "event_id")],
        F.date_format("ts", ISO).alias("created_at"),
        *_lineage(
            "transactions",
            F.lit("c"),
            millis(F.col("ts")),
            F.col("event_id") % 3,
            F.col("event_id"),
        ),
    )
    again = created.filter(F.col("_kafka_offset") % 7 == 0)
    updated = created.filter(F.col("_kafka_offset") % 5 == 0).withColumns(
        {
            "_cdc_op": F.lit("u"),
            "status": F.lit("REVERSED"),
            "_cdc_ts_ms": F.col("_cdc_ts_ms") + 1000,
            "_kafka_offset": F.col("_kafka_offset") + 1_000_000_000,
        }
    )
    return created.unionByName(again).unionByName(updated)


def facts(spark: SparkSession, sf_dir: str, account: Column | None = None) -> DataFrame:
    """Fact rows taken directly from the events, for queries about features and rules."""
    images = transaction_images(table(spark, sf_dir, "events"), account)
    return images.select(
        *[c for c in images.columns if c not in ("ts", "event_id")],
        F.col("from_account_id").alias("from_customer_id"),
        F.col("ts").alias("created_at"),
        date_key(F.col("ts")).alias("date_id"),
    )


def customer_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_custkey")
    return joined.select(
        key.cast("string").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.concat("c_name", F.lit(" "), "o_orderpriority").alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias(
            "email"
        ),
        F.lpad(key.cast("string"), 10, "0").alias("national_id"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key % 18000).cast("int")).alias(
            "date_of_birth"
        ),
        F.lit("1995-01-01T00:00:00Z").alias("created_at"),
        F.date_format("o_orderdate", ISO).alias("updated_at"),
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of ``customers``: changes, some at the same time, and deletes."""
    images = customer_images(spark, sf_dir)
    hidden = hide_personal_columns(images, "customers", SALT)
    return hidden.select(
        *[c for c in images.columns if not c.startswith("o_")],
        *_lineage(
            "customers",
            F.when(F.col("o_orderkey") % 40 == 0, "d").otherwise("u"),
            millis(F.col("o_orderdate")),
            F.col("o_custkey") % 3,
            F.col("o_orderkey"),
        ),
    )


def _bytes_text(amount: Column) -> Column:
    """Base64 of the unscaled number of an amount of scale 2, as a connector with precise decimals sends it."""
    unscaled = (amount * 100).cast("bigint")
    digits = F.hex(unscaled)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    signed = F.when((unscaled >= 0) & (F.substring(even, 1, 1) >= "8"), F.concat(F.lit("00"), even)).otherwise(even)
    return F.base64(F.unhex(signed))


def account_messages(spark: SparkSession, sf_dir: str, encoding: str = "plain") -> DataFrame:
    """Raw messages of the account topic as JSON text.

    Deletes carry only a before image, updates both, inserts only an after image. Every tenth
    message has no source time; some values are null, some are cut off. With ``encoding`` "connect" every message
    whose number is not divisible by three has its decimals as bytes, half of them below ``payload`` with a schema
    beside it. With "registry" each has a header: id 7 before half of all messages, then id 9.
    """
    images = account_images(table(spark, sf_dir, "events"))
    names = [c for c in images.columns if c not in ("event_id", "user_id", "ts")]
    number = F.col("event_id")
    encoded = number % 3 != 0 if encoding == "connect" else F.lit(False)

    def sent(name: str, shift: int) -> Column:
        value = (F.col(name) + shift if name == "balance" else F.col(name)).cast(images.schema[name].dataType)
        if encoding != "connect" or name != "balance":
            return value.alias(name)
        return F.when(encoded, _bytes_text(value)).otherwise(value.cast("string")).alias(name)

    image = F.struct(*[sent(n, 0) for n in names])
    earlier = F.struct(*[sent(n, 1) for n in names])
    op = F.when(number % 50 == 0, "d").when(number % 3 == 0, "c").otherwise("u")
    at = millis(F.col("ts"))
    envelope = F.struct(
        F.when(op != "c", earlier).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.struct(F.when(number % 10 == 0, 0).otherwise(at).alias("ts_ms")).alias("source"),
        (at + 5).alias("ts_ms"),
    )
    bare = F.to_json(envelope)
    text = bare
    if encoding == "connect":
        wrapped = F.to_json(F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"), envelope.alias("payload")))
        text = F.when(encoded & (number % 2 == 0), wrapped).otherwise(bare)
    value = F.when(number % 31 == 1, F.lit(None)).when(number % 37 == 1, F.substring(bare, 1, 40)).otherwise(text)
    if encoding == "registry":
        header = F.when(F.col("user_id") % 2 == 0, F.lit("0000000007")).otherwise(F.lit("0000000009"))
        value = F.concat(F.unhex(header), value.cast("binary"))
    return images.select(
        F.lit(f"{TOPIC_PREFIX}.accounts").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        number.alias("offset"),
        value.alias("value"),
        F.timestamp_millis(at + 7).alias("timestamp"),
    )


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages of the customer topic: dates of birth as days since 1970, every fourth one as ISO text."""
    images = customer_images(spark, sf_dir)
    number = F.col("o_orderkey")
    birth = F.col("date_of_birth")
    days = F.unix_date(birth).cast("string")
    names = [c for c in images.columns if not c.startswith("o_")]
    sent = F.when(number % 4 == 0, birth.cast("string")).otherwise(days).alias("date_of_birth")
    image = F.struct(*[sent if n == "date_of_birth" else F.col(n) for n in names])
    at = millis(F.col("o_orderdate"))
    delete = number % 40 == 0
    envelope = F.struct(
        F.when(delete, image).alias("before"),
        F.when(~delete, image).alias("after"),
        F.when(delete, "d").otherwise("u").alias("op"),
        F.struct(at.alias("ts_ms")).alias("source"),
        at.alias("ts_ms"),
    )
    # a number is not quoted
    text = F.regexp_replace(F.to_json(F.struct(envelope.alias("payload"))), r'"date_of_birth":"(-?[0-9]+)"', '"date_of_birth":$1')
    return images.select(
        F.lit(f"{TOPIC_PREFIX}.customers").alias("topic"),
        (F.col("o_custkey") % 3).cast("int").alias("partition"),
        number.alias("offset"),
        text.alias("value"),
        F.timestamp_millis(at + 7).alias("timestamp"),
    )
