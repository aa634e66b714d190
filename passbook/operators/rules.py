"""Explainable rules over completed transactions with activity features.

Input is the frame of ``activity.with_activity``: it already carries the fact columns, so no rule
joins features back to facts. Output grain: one row per (transaction, rule).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.functions.scalars import double_text, md5_key, round_double

# Thresholds.
BURST_MIN_TRANSFERS = 5
OUTLIER_MEANS = 4
OUTLIER_DEVIATIONS = 2
SPIKE_MIN_PER_DAY = 5
SPIKE_TIMES_AVERAGE = 3

CARRIED = [
    "transaction_id",
    "from_account_id",
    "from_customer_id",
    "amount",
    "transaction_type",
    "status",
    "created_at",
]


def _ratio(value: Column, base: str) -> Column:
    return value.cast("double") / F.nullif(F.col(base), F.lit(0.0))


# Each rule: when it fires, its explanation, its score.
def _burst() -> tuple[Column, Column, Column]:
    n = F.col("transfers_in_2h_window")
    fires = (
        (F.col("transaction_type") == "TRANSFER")
        & (F.col("status") == "COMPLETED")
        & (n >= BURST_MIN_TRANSFERS)
    )
    # Fixed value: wording of the explanation.
    text = F.concat(n.cast("string"), F.lit(" transfers from same account in 2-hour window"))
    return fires, text, n.cast("decimal(10,2)").cast("double")


def _high_value() -> tuple[Column, Column, Column]:
    mean, deviation = F.col("acct_mean_amount"), F.col("acct_stddev_amount")
    limit = mean * OUTLIER_MEANS + deviation * OUTLIER_DEVIATIONS
    fires = (
        (F.col("status") == "COMPLETED")
        & (mean > 0)
        & (F.col("amount").cast("double") > limit)
    )
    ratio = _ratio(F.col("amount"), "acct_mean_amount")
    # Wording of the explanation.
    text = F.concat(
        F.lit("Amount "),
        F.col("amount").cast("decimal(18,2)").cast("string"),
        F.lit(" is "),
        double_text(round_double(ratio, 1), 1),
        F.lit("x account mean ("),
        double_text(round_double(mean, 2), 2),
        F.lit(")"),
    )
    return fires, text, round_double(ratio, 2)


def _dormant_spike() -> tuple[Column, Column, Column]:
    n, average = F.col("txns_on_same_day"), F.col("avg_daily_txns")
    fires = (
        (F.col("status") == "COMPLETED")
        & (average > 0)
        & (n >= SPIKE_MIN_PER_DAY)
        & (n > average * SPIKE_TIMES_AVERAGE)
    )
    # Wording of the explanation.
    text = F.concat(
        n.cast("string"),
        F.lit(" transactions on this day vs avg "),
        double_text(round_double(average, 1), 1),
        F.lit("/day"),
    )
    return fires, text, round_double(_ratio(n, "avg_daily_txns"), 2)


RULES = {
    "BURST_TRANSFER": _burst,
    "HIGH_VALUE_OUTLIER": _high_value,
    "DORMANT_SPIKE": _dormant_spike,
}


def flags_of(activity: DataFrame, code: str) -> DataFrame:
    """Hits of one rule."""
    fires, text, score = RULES[code]()
    return activity.filter(fires).select(
        *CARRIED,
        F.lit(code).alias("rule_code"),
        text.alias("rule_description"),
        score.alias("rule_score"),
    )


def union_flags(*flags: DataFrame) -> DataFrame:
    """All hits of separately computed rules, duplicates kept."""
    return reduce(DataFrame.unionByName, flags)


def all_flags(activity: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Hits of several rules in one pass: rows that hit nothing are dropped before the explode."""
    rules = [(code, *RULES[code]()) for code in codes or list(RULES)]
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    fires,
                    F.struct(
                        F.lit(code).alias("rule_code"),
                        text.alias("rule_description"),
                        score.alias("rule_score"),
                    ),
                )
                for code, fires, text, score in rules
            ]
        )
    )
    any_fires = reduce(lambda a, b: a | b, [fires for _, fires, _, _ in rules])
    return (
        activity.filter(any_fires)
        .withColumn("_hit", F.explode(hits))
        .select(*CARRIED, "_hit.rule_code", "_hit.rule_description", "_hit.rule_score")
    )


def with_flag_key(flags: DataFrame, flagged_at: Column | None = None) -> DataFrame:
    """Add the surrogate key first and the load time last."""
    return flags.select(
        md5_key(F.col("transaction_id"), F.col("rule_code")).alias("flag_sk"),
        "*",
        (F.current_timestamp() if flagged_at is None else flagged_at).alias("flagged_at"),
    )
