"""Report queries over the marts. Each returns a frame; the caller decides how to show it.

Ties are broken by key, so every report is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.functions.scalars import round_double


def customer_count(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.agg(F.count(F.lit(1)).alias("customers"))


def version_statistics(dim_accounts: DataFrame) -> DataFrame:
    """Counts are null, not 0, where no version is of the kind."""
    one = F.lit(1).cast("bigint")
    return dim_accounts.agg(
        F.count(F.lit(1)).alias("total_versions"),
        F.count_distinct("account_id").alias("unique_accounts"),
        F.sum(F.when(F.col("is_current"), one)).alias("current_versions"),
        F.sum(F.when(~F.col("is_current"), one)).alias("historical_versions"),
        F.max("version_number").cast("bigint").alias("max_versions_per_account"),
    )


def fact_totals(fact: DataFrame, by_currency: bool = False, k: int = 8) -> DataFrame:
    """Most frequent (type, status) pairs. Amounts of all currencies are added unless split."""
    keys = ["transaction_type", "status"] + (["currency"] if by_currency else [])
    totals = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.round(F.sum("amount"), 2).cast("decimal(28,2)").alias("total_amount"),
    )
    return totals.orderBy(F.desc("cnt"), *keys).limit(k)


def multi_version_accounts(dim_accounts: DataFrame, k: int = 3) -> DataFrame:
    """All versions of the first ``k`` accounts that have more than one."""
    chosen = (
        dim_accounts.groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .orderBy("account_id")
        .limit(k)
        .select("account_id")
    )
    # k rows: safe to broadcast
    return (
        dim_accounts.join(F.broadcast(chosen), "account_id", "left_semi")
        .select("account_id", "version_number", "balance", "status", "valid_from", "is_current")
        .orderBy("account_id", "version_number")
    )


def flags_by_rule(flags: DataFrame) -> DataFrame:
    """Flag counts and scores per rule.

    A transaction belongs to one account, so distinct transactions add up over accounts: one
    distinct count per step, and no copy of every flag per distinct column.
    """
    per_account = flags.groupBy("rule_code", "from_account_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("transaction_id").alias("_txns"),
        F.sum("rule_score").alias("_sum"),
        F.count("rule_score").alias("_scored"),
        F.min("rule_score").alias("_min"),
        F.max("rule_score").alias("_max"),
    )
    return (
        per_account.groupBy("rule_code")
        .agg(
            F.sum("_n").alias("flag_count"),
            F.sum("_txns").alias("unique_txns"),
            F.count("from_account_id").alias("unique_accounts"),
            round_double(F.min("_min"), 2).alias("min_score"),
            round_double(F.sum("_sum") / F.sum("_scored"), 2).alias("avg_score"),
            round_double(F.max("_max"), 2).alias("max_score"),
        )
        .orderBy(F.desc("flag_count"), "rule_code")
    )


def multi_rule_accounts(flags: DataFrame, k: int = 10) -> DataFrame:
    """Accounts hit by more than one rule; the set holds rule codes only, so it stays tiny."""
    codes = F.collect_set("rule_code")
    return (
        flags.groupBy("from_account_id")
        .agg(
            F.size(codes).cast("bigint").alias("rules_fired"),
            F.count(F.lit(1)).alias("total_flags"),
            F.array_join(F.sort_array(codes), ", ").alias("rules"),
        )
        .filter("rules_fired > 1")
        .orderBy(F.desc("rules_fired"), F.desc("total_flags"), "from_account_id")
        .limit(k)
    )


def top_bursts(flags: DataFrame, k: int = 5) -> DataFrame:
    return (
        flags.filter(F.col("rule_code") == "BURST_TRANSFER")
        .orderBy(F.desc("rule_score"), "transaction_id")
        .limit(k)
        .select(
            "transaction_id",
            "from_account_id",
            F.round("amount", 2).cast("decimal(18,2)").alias("amount"),
            "created_at",
            F.col("rule_score").alias("transfers_in_2h"),
            "rule_description",
        )
    )


def top_high_values(flags: DataFrame, k: int = 5) -> DataFrame:
    return (
        flags.filter(F.col("rule_code") == "HIGH_VALUE_OUTLIER")
        .orderBy(F.desc("rule_score"), "transaction_id")
        .limit(k)
        .select(
            "transaction_id",
            F.round("amount", 2).cast("decimal(18,2)").alias("amount"),
            round_double(F.col("rule_score"), 2).alias("amount_vs_mean"),
            "rule_description",
        )
    )
