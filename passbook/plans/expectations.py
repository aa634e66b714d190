"""Data tests of the ten models: 52 not-null, 7 unique, 8 accepted-values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from passbook.contracts import (
    ACCOUNT_STATUSES,
    ACCOUNT_TYPES,
    CURRENCIES,
    RULE_CODES,
    TRANSACTION_STATUSES,
    TRANSACTION_TYPES,
)
from passbook.operators.quality import (
    Expectation,
    accepted_values,
    check,
    not_null,
    run_expectations,
    unique,
)

# Which columns are tested how.
MODEL_TESTS: dict[str, list[Expectation]] = {
    "stg_customers": [
        *unique("customer_id"),
        *not_null(
            "customer_id",
            "first_name_token",
            "last_name_token",
            "email_token",
            "national_id_token",
            "date_of_birth_token",
            "_cdc_op",
        ),
    ],
    "stg_accounts": [
        *not_null("account_id", "customer_id", "account_number_token", "balance", "status", "_cdc_ts_ms"),
        *accepted_values("status", ACCOUNT_STATUSES),
    ],
    "stg_transactions": [
        *unique("transaction_id"),
        *not_null("transaction_id", "from_account_id", "amount"),
        *accepted_values("transaction_type", TRANSACTION_TYPES),
        *accepted_values("status", TRANSACTION_STATUSES),
    ],
    "int_account_changes": not_null("account_id", "change_ts_ms", "balance", "status"),
    "dim_customers": [
        *unique("customer_id"),
        *not_null("customer_id", "first_name_token", "email_token"),
    ],
    "dim_accounts": [
        *unique("account_sk"),
        *not_null(
            "account_sk",
            "account_id",
            "customer_id",
            "balance",
            "status",
            "valid_from",
            "is_current",
            "version_number",
        ),
        *accepted_values("status", ACCOUNT_STATUSES),
        *accepted_values("is_current", [True, False]),
    ],
    "dim_date": [*unique("date_id"), *not_null("date_id", "date_day")],
    "fact_transactions": [
        *unique("transaction_id"),
        *not_null("transaction_id", "from_account_id", "amount", "date_id"),
        *accepted_values("transaction_type", TRANSACTION_TYPES),
        *accepted_values("status", TRANSACTION_STATUSES),
    ],
    "int_txn_features": not_null(
        "transaction_id",
        "from_account_id",
        "transfers_in_2h_window",
        "acct_mean_amount",
        "txns_on_same_day",
        "avg_daily_txns",
    ),
    "mart_suspicious_transactions": [
        *unique("flag_sk"),
        *not_null(
            "flag_sk",
            "transaction_id",
            "rule_code",
            "rule_score",
            "rule_description",
            "from_account_id",
            "amount",
            "created_at",
            "flagged_at",
        ),
        *accepted_values("rule_code", RULE_CODES),
    ],
}


def _in_list(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# Row rules of the source tables, checked on landing rows.
LANDING_CHECKS: dict[str, list[Expectation]] = {
    "accounts": [
        *check("account_type", _in_list("account_type", ACCOUNT_TYPES)),
        *check("currency", _in_list("currency", CURRENCIES)),
        *check("status", _in_list("status", ACCOUNT_STATUSES)),
    ],
    "transactions": [
        *check("amount", "amount > 0"),
        *check("transaction_type", _in_list("transaction_type", TRANSACTION_TYPES)),
        *check("status", _in_list("status", TRANSACTION_STATUSES)),
    ],
}


def test_models(models: dict[str, DataFrame]) -> DataFrame:
    """Results of all tests of the given models."""
    results = [run_expectations(name, rows, MODEL_TESTS[name]) for name, rows in models.items()]
    return reduce(DataFrame.unionByName, results)


test_models.__test__ = False  # not a pytest case
