"""Activity features and suspicious transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from passbook.operators.activity import FEATURES, completed, with_activity
from passbook.operators.rules import all_flags, with_flag_key
from passbook.operators.skew import DEFAULT_POLICY, SkewPolicy


def completed_with_features(fact: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Completed facts, all columns, with features: the input of the rules."""
    return with_activity(completed(fact), policy=policy)


def feature_columns(rows: DataFrame) -> DataFrame:
    """One row of features per completed transaction (input: ``completed_with_features``)."""
    return rows.select("transaction_id", "from_account_id", "amount", *FEATURES)


def int_txn_features(fact: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    return feature_columns(completed_with_features(fact, policy))


def flags(
    fact: DataFrame, codes: list[str] | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    return all_flags(completed_with_features(fact, policy), codes)


def mart_suspicious_transactions(
    fact: DataFrame,
    flagged_at: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per (transaction, rule that fired)."""
    return with_flag_key(flags(fact, policy=policy), flagged_at)
