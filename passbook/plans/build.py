"""Full rebuild: landing zone → models → tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.contracts import PERSONAL_COLUMNS
from passbook.operators.history import version_intervals
from passbook.operators.messages import POSITION
from passbook.operators.quality import gate
from passbook.operators.rules import all_flags, with_flag_key
from passbook.operators.skew import DEFAULT_POLICY, SLOT, SkewPolicy
from passbook.plans import anomaly, marts, staging
from passbook.plans.expectations import test_models
from passbook.sources.calendar import dim_date
from passbook.sources.landing import scan
from passbook.sources.martstore import Build, as_mart, read_mart  # noqa: F401
from passbook.workspace import temporary_tables

TABLES = [
    "dim_customers",
    "dim_accounts",
    "dim_date",
    "fact_transactions",
    "mart_suspicious_transactions",
]


#: Which column deals a mart's rows into buckets; other marts are one bucket.
DEALT = {
    "stg_accounts": "account_id",
    "account_changes_in_order": "account_id",
    "dim_accounts": "account_id",
    "dim_customers": "customer_id",
    "fact_transactions": "from_account_id",
    "completed_with_features": "from_account_id",
}


def as_view(name: str, rows: DataFrame) -> DataFrame:
    rows.createOrReplaceTempView(name)
    return rows


def without_erased(accounts: DataFrame, erased: DataFrame) -> DataFrame:
    """Accounts of erased customers say so instead of naming the customer; their tokens go too."""
    gone = erased.select(F.col("customer_id").alias("_erased"))
    joined = accounts.join(gone, F.col("customer_id") == F.col("_erased"), "left")
    hidden = ["customer_id", *(f"{c}_token" for c in PERSONAL_COLUMNS["accounts"])]
    kept = {c: F.when(F.col("_erased").isNull(), F.col(c)).otherwise(F.lit("erased")) for c in hidden}
    return joined.withColumns(kept).select(*accounts.columns)


def build_models(
    landing: dict[str, DataFrame],
    calendar: DataFrame,
    table: Callable[[str, DataFrame], DataFrame],
    view: Callable[[str, DataFrame], DataFrame] | None = None,
    flagged_at: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    drop_deleted: bool = False,
) -> dict[str, DataFrame]:
    """All ten models. ``table`` says how marts are kept, ``view`` how staging and features are.

    Without ``view`` everything that is read more than once is kept like a mart: the later models
    and the data tests then scan pruned columns instead of repeating the shuffles of staging.
    ``drop_deleted`` erases deleted customers: they leave the customer models, and their accounts and
    transactions keep no link to them.
    """
    keep = view or table
    m: dict[str, DataFrame] = {}
    m["stg_customers"] = keep("stg_customers", staging.stg_customers(landing["customers"], drop_deleted))
    accounts = staging.stg_accounts(landing["accounts"], policy)
    if drop_deleted:
        accounts = without_erased(accounts, staging.erased_customers(landing["customers"]))
    m["stg_accounts"] = keep("stg_accounts", accounts)
    m["stg_transactions"] = keep(
        "stg_transactions", staging.stg_transactions(landing["transactions"])
    )
    changes = keep("account_changes_in_order", marts.changes_in_order(m["stg_accounts"], policy=policy))
    m["int_account_changes"] = changes.drop(*POSITION, SLOT)
    m["dim_customers"] = table("dim_customers", marts.dim_customers(m["stg_customers"]))
    m["dim_accounts"] = table("dim_accounts", version_intervals(changes, policy=policy))
    m["dim_date"] = table("dim_date", calendar)
    m["fact_transactions"] = table(
        "fact_transactions", marts.fact_transactions(m["stg_transactions"], m["dim_accounts"])
    )
    featured = keep(
        "completed_with_features", anomaly.completed_with_features(m["fact_transactions"], policy)
    )
    m["int_txn_features"] = anomaly.feature_columns(featured)
    m["mart_suspicious_transactions"] = table(
        "mart_suspicious_transactions", with_flag_key(all_flags(featured), flagged_at)
    )
    return m


def rebuild(
    spark: SparkSession,
    landing_base: str,
    mart_base: str,
    anchor: str | None = None,
    flagged_at: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    view: Callable[[str, DataFrame], DataFrame] | None = None,
    drop_deleted: bool = False,
) -> DataFrame:
    """Build all models from the landing zone, test them, and publish them if no ``error`` test fails.

    Until then, and if a test fails, readers (``read_mart``) see the marts of the build before.
    Pass ``view=as_view`` to keep staging and features as views. Returns the test results.
    """
    landing = {t: scan(spark, landing_base, t) for t in ("customers", "accounts", "transactions")}
    with temporary_tables(spark):
        build = Build(spark, mart_base)
        models = build_models(landing, dim_date(spark, anchor), as_mart(build, DEALT), view, flagged_at, policy, drop_deleted)
        results = gate(test_models(models))
        kept = spark.createDataFrame(results.collect(), results.schema)  # one row per test
        build.publish()
        return kept
