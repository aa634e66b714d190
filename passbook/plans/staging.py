"""Staging models over landing rows: one function per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.contracts import PERSONAL_COLUMNS
from passbook.functions.scalars import iso_to_utc
from passbook.operators.messages import (
    POSITION,
    drop_redelivered,
    earliest_per_key,
    latest_per_key,
)
from passbook.operators.skew import DEFAULT_POLICY, SLOT, SkewPolicy, placed, with_slot


def _tokens(table: str) -> list:
    return [F.col(c).alias(f"{c}_token") for c in PERSONAL_COLUMNS[table]]


def stg_customers(landing: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Latest state per customer. ``drop_deleted`` removes customers whose last event deletes them."""
    latest = latest_per_key(landing, ["customer_id"], drop_deleted=drop_deleted)
    return latest.select(
        "customer_id",
        *_tokens("customers"),
        "created_at",
        "updated_at",
        "_cdc_op",
        "_cdc_ts_ms",
    )


def erased_customers(landing: DataFrame) -> DataFrame:
    """Customers whose last event deletes them."""
    every = landing.withColumn("_last_op", F.col("_cdc_op")).withColumn("_cdc_op", F.lit("u"))
    last = latest_per_key(every, ["customer_id"])
    return last.filter(F.col("_last_op") == "d").select("customer_id")


def account_events(landing: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Changes of accounts, deletes left out, copies of re-delivered messages still in.

    The log position stays, because it decides the order of changes in the same millisecond, and so
    does the slot of heavy accounts: found here on the raw log (one job over two columns), it lets
    the history jobs restrict their extra work to heavy accounts before any shuffle.
    ``marts.dim_accounts`` drops the copies on its way: the log then crosses the network once.
    """
    live = landing.filter(F.col("_cdc_op") != "d")
    along = placed(F.col("_cdc_ts_ms"), *[F.col(c) for c in POSITION])
    return with_slot(live, "account_id", along, policy).select(
        "account_id",
        "customer_id",
        *_tokens("accounts"),
        "account_type",
        "currency",
        F.col("balance").cast("decimal(18,2)").alias("balance"),
        "status",
        "created_at",
        "updated_at",
        "_cdc_op",
        "_cdc_ts_ms",
        *POSITION,
        SLOT,
    )


def stg_accounts(landing: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Every change of every account once, deletes left out."""
    # copies agree in every column; account and slot are in the key so that filters on them pass
    return drop_redelivered(account_events(landing, policy), ["account_id", SLOT, *POSITION])


def stg_transactions(landing: DataFrame) -> DataFrame:
    """First event per transaction; ``created_at`` is parsed here, once."""
    return earliest_per_key(landing, ["transaction_id"]).select(
        "transaction_id",
        "from_account_id",
        "to_account_id",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "currency",
        "transaction_type",
        "status",
        "description",
        iso_to_utc(F.col("created_at")).alias("created_at"),
        "_cdc_ts_ms",
    )
