"""Marts in versions: the full build behind a gate, and a refresh that recomputes affected keys only.

Both write new generations aside and publish them after the data tests (see ``sources.martstore``): a failing
test leaves the marts of the build before in place. A refresh starts from the rows that landed since the last
build. It finds which keys they touch, recomputes the buckets of those keys from stored staging rows, and
publishes them beside the untouched buckets of earlier builds. Late rows count like any others: each bucket
is recomputed from all its history.

All account-bound marts are dealt by the hash of the account, so the fact, its owner, the account's versions and the
account's features are in buckets of one number, and a bucket needs no other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.operators.history import version_intervals
from passbook.operators.messages import POSITION, drop_redelivered, earliest_per_key, latest_per_key
from passbook.operators.quality import gate, run_expectations
from passbook.operators.rules import all_flags, with_flag_key
from passbook.operators.skew import DEFAULT_POLICY, SLOT, SkewPolicy
from passbook.plans import anomaly, marts, staging
from passbook.plans.expectations import MODEL_TESTS
from passbook.sources import landing
from passbook.sources.calendar import dim_date
from passbook.sources.martstore import BUCKET, BUCKETS, Build, bucket_of
from passbook.workspace import stored, temporary_tables

SOURCES = ("customers", "accounts", "transactions")
#: Which column deals a mart's rows. The logs hold the landing rows that decide a key's state.
KEYS = {
    "log_customers": "customer_id",
    "log_accounts": "account_id",
    "log_transactions": "transaction_id",
    "dim_customers": "customer_id",
    "dim_accounts": "account_id",
    "fact_transactions": "from_account_id",
    "mart_suspicious_transactions": "from_account_id",
}
#: Marts that a refresh tests on the buckets it has written.
TESTED = ("dim_customers", "dim_accounts", "dim_date", "fact_transactions", "mart_suspicious_transactions")


def _touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """Buckets of the rows' keys: at most ``buckets`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(F.col(key), buckets)).distinct().collect())


class _Refresh:
    def __init__(self, build: Build, news: dict[str, DataFrame], buckets: int, policy: SkewPolicy, flagged_at: Column | None, whole: bool):
        self.build, self.news, self.buckets, self.policy, self.flagged_at, self.whole = build, news, buckets, policy, flagged_at, whole
        self.written: dict[str, list[int]] = {}

    def old(self, name: str, only: list[int]) -> DataFrame | None:
        """Buckets of a mart of the build before; None in a full build."""
        return None if self.whole else self.build.read(name, only).drop(BUCKET)

    def write(self, name: str, rows: DataFrame, only: list[int]) -> DataFrame:
        """Write the buckets ``only`` of a mart and return them."""
        self.written[name] = only
        self.build.write(name, rows, KEYS[name], self.buckets, replaced=None if self.whole else only)
        return self.build.read(name, only).drop(BUCKET)

    def log(self, source: str, reduce_: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        """The source's log in the touched buckets: what was there and what is new, reduced."""
        name, news = f"log_{source}", self.news[source]
        only = list(range(self.buckets)) if self.whole else _touched(news, KEYS[name], self.buckets)
        before = self.old(name, only)
        both = news if before is None else news.unionByName(before)
        return self.write(name, reduce_(both), only), only

    def customers(self) -> None:
        log, only = self.log("customers", lambda rows: latest_per_key(rows, ["customer_id"]))
        self.write("dim_customers", marts.dim_customers(staging.stg_customers(log)), only)

    def accounts(self) -> list[int]:
        log, only = self.log("accounts", drop_redelivered)
        events = staging.account_events(log, self.policy)
        changes = marts.changes_in_order(events, policy=self.policy)
        self.write("dim_accounts", version_intervals(changes, policy=self.policy), only)
        return only

    def transactions(self, accounts: list[int]) -> None:
        """First events, then the fact rows of every account that a changed transaction or owner touches."""
        name, news = "log_transactions", self.news["transactions"]
        only = list(range(self.buckets)) if self.whole else _touched(news, KEYS[name], self.buckets)
        before = self.old(name, only)
        both = news if before is None else news.unionByName(before)
        log = self.write(name, earliest_per_key(both, ["transaction_id"]), only)
        if before is None:
            affected = list(range(self.buckets))
            first = log
        else:
            known = before.select("transaction_id", *(F.col(c).alias(f"_old_{c}") for c in [*POSITION, "from_account_id"]))
            pairs = log.join(known, "transaction_id", "left")
            same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in POSITION))
            changed = stored(pairs.filter(~same | F.col("_old__kafka_offset").isNull()), "changed")
            # an earlier event may name another account: both lose or gain a row
            named = changed.select(F.explode(F.array("from_account_id", "_old_from_account_id")).alias("account"))
            affected = sorted({*accounts, *_touched(named, "account", self.buckets)})
            first = changed.select(*log.columns)
        staged = staging.stg_transactions(first)
        owners = self.build.read("dim_accounts", affected).drop(BUCKET)
        fact = marts.fact_transactions(staged, owners)
        if before is not None:
            # facts that stay, with the owner as it is now
            stay = self.old("fact_transactions", affected).join(first.select("transaction_id"), "transaction_id", "left_anti")
            plain = stay.withColumnRenamed("cdc_ingested_at_ms", "_cdc_ts_ms").drop("from_customer_id", "date_id")
            fact = fact.unionByName(marts.fact_transactions(plain, owners))
        fact = self.write("fact_transactions", fact, affected)
        featured = stored(anomaly.completed_with_features(fact, self.policy), "features")  # every rule reads them
        flags = with_flag_key(all_flags(featured), self.flagged_at)
        self.write("mart_suspicious_transactions", flags, affected)

    def tests(self) -> DataFrame:
        """The marts' tests on what has been written. A key's rows are in one bucket, so uniqueness is too,
        but for transactions that changed their account: their old row leaves in the same refresh."""
        results = []
        for name in TESTED:
            if name in self.build.marts:
                rows = self.build.read(name, self.written.get(name))
                results.append(run_expectations(name, rows.drop(BUCKET), MODEL_TESTS[name]))
        return reduce(DataFrame.unionByName, results)


def _run(
    spark: SparkSession,
    landing_base: str,
    mart_base: str,
    anchor: str | None,
    flagged_at: Column | None,
    buckets: int,
    policy: SkewPolicy,
    whole: bool,
) -> DataFrame:
    build = Build(spark, mart_base)
    heads = {t: landing.head(spark, landing_base, t) for t in SOURCES}
    if whole:
        news = {t: landing.scan(spark, landing_base, t, version=heads[t]) for t in SOURCES}
    else:
        seen = build.before["notes"]["landing"]
        buckets = build.before["notes"]["buckets"]
        news = {t: landing.scan_since(spark, landing_base, t, seen[t], heads[t]) for t in SOURCES}
    with temporary_tables(spark):
        run = _Refresh(build, news, buckets, policy, flagged_at, whole)
        run.customers()
        run.transactions(run.accounts())
        if whole:
            build.write("dim_date", dim_date(spark, anchor))
        results = gate(stored(run.tests(), "tests"))
        kept = spark.createDataFrame(results.collect(), results.schema)  # one row per test
    build.publish(landing=heads, buckets=buckets)
    return kept


def full(
    spark: SparkSession,
    landing_base: str,
    mart_base: str,
    anchor: str | None = None,
    flagged_at: Column | None = None,
    buckets: int = BUCKETS,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Build all marts from all landing rows, test them, publish them. Returns the test results."""
    return _run(spark, landing_base, mart_base, anchor, flagged_at, buckets, policy, whole=True)


def refresh(
    spark: SparkSession,
    landing_base: str,
    mart_base: str,
    flagged_at: Column | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Bring the published marts up to date with what has landed since, recomputing only the buckets it touches.

    Equals ``full`` on the same landing zone, but for ``flagged_at`` of flags in buckets that were not touched.
    Erasure of deleted customers needs a full build. Run it before ``landing.vacuum`` deletes folders that the
    last build has not read.
    """
    return _run(spark, landing_base, mart_base, None, flagged_at, BUCKETS, policy, whole=False)
