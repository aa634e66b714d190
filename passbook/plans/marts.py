"""Dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.contracts import PERSONAL_COLUMNS
from passbook.functions.scalars import date_key
from passbook.operators.history import TRACKED, change_points, version_intervals
from passbook.operators.messages import POSITION
from passbook.operators.skew import DEFAULT_POLICY, SLOT, SkewPolicy

_CHANGE_COLUMNS = [
    "account_id",
    "customer_id",
    "account_number_token",
    "account_type",
    "currency",
    "balance",
    "status",
    "created_at",
]


def changes_in_order(
    accounts: DataFrame,
    tracked: tuple[str, ...] = TRACKED,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Changes of a tracked column with position and slot: what versions are built from."""
    found = change_points(accounts, tracked=tracked, policy=policy, keep_slot=True)
    return found.select(
        *_CHANGE_COLUMNS, F.col("_cdc_ts_ms").alias("change_ts_ms"), *POSITION, SLOT
    )


def account_changes(
    accounts: DataFrame,
    tracked: tuple[str, ...] = TRACKED,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Changes of a tracked column, one row each (input: ``stg_accounts`` or ``account_events``)."""
    return changes_in_order(accounts, tracked, policy).drop(*POSITION, SLOT)


def dim_accounts(
    accounts: DataFrame,
    tracked: tuple[str, ...] = TRACKED,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Type 2 account dimension (input: ``stg_accounts`` or ``account_events``).

    Dropping copies, change detection and versions share one exchange on (account, slot).
    """
    return version_intervals(changes_in_order(accounts, tracked, policy), policy=policy)


def dim_customers(customers: DataFrame) -> DataFrame:
    """Type 1 customer dimension (input: ``stg_customers``)."""
    tokens = [f"{c}_token" for c in PERSONAL_COLUMNS["customers"]]
    return customers.select("customer_id", *tokens, "created_at", "updated_at")


def fact_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions with the owner of the source account.

    Inputs: ``stg_transactions`` and ``dim_accounts``. No broadcast is forced: the account side
    grows with the bank, and adaptive execution broadcasts it when it turns out small and splits
    heavy accounts when it does not.
    """
    owners = accounts.filter("is_current").select(
        F.col("account_id").alias("_owned"), F.col("customer_id").alias("from_customer_id")
    )
    joined = transactions.join(owners, F.col("from_account_id") == F.col("_owned"), "left")
    return joined.select(
        "transaction_id",
        "from_account_id",
        "to_account_id",
        "from_customer_id",
        "amount",
        "currency",
        "transaction_type",
        "status",
        "description",
        "created_at",
        date_key(F.col("created_at")).alias("date_id"),
        F.col("_cdc_ts_ms").alias("cdc_ingested_at_ms"),
    )
