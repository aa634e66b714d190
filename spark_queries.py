"""Registered queries: every operator of the library, run over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook import fixtures as fx
from passbook.contracts import landing_schema
from passbook.functions import scalars as sc
from passbook.operators import activity, connect, envelope, governance, history, messages, quality, rules
from passbook.operators.skew import SkewPolicy
from passbook.plans import anomaly, build, expectations, marts, refresh, reports, staging
from passbook.sources import calendar, landing, martstore
from passbook.sources import messages as sources
from passbook.streaming import bursts, ingest
from passbook.workspace import fresh_path, prepare, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ANCHOR = "2024-01-15"
AS_OF = "2031-01-08"  # expires the first ten days of the events under seven years
FLAGGED_AT = "2024-02-01 00:00:00"
# Treats nearly every account as heavy and cuts it into many slots, to exercise that path.
SPLIT = SkewPolicy(min_rows=20, slot_rows=7)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _mod10():
    return F.col("user_id") % 10


def _blended():
    """Two accounts take half of the events of every tenth day each, so that one fact fires all rules."""
    busy = F.dayofmonth("ts") % 10 == F.col("user_id") % 2
    return F.when(busy, F.col("user_id") % 2).otherwise(F.col("user_id"))


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: sc.round_double(F.col(c), 6) for c in columns})


# --- messages and staging --------------------------------------------------------------------


@query
def msg_dedup(spark, sf):
    return messages.drop_redelivered(fx.account_log(spark, sf)).select(
        "account_id", "balance", "status", "_cdc_op", "_cdc_ts_ms", "_kafka_partition", "_kafka_offset"
    )


@query
def latest_state_scd1(spark, sf):
    return staging.stg_customers(fx.customer_log(spark, sf))


@query
def latest_state_erasure(spark, sf):
    return staging.stg_customers(fx.customer_log(spark, sf), drop_deleted=True)


@query
def first_event(spark, sf):
    return staging.stg_transactions(fx.transaction_log(spark, sf))


# --- history ---------------------------------------------------------------------------------


@query
def stg_accounts(spark, sf):
    return staging.stg_accounts(fx.account_log(spark, sf)).drop("_slot")


@query
def account_changes(spark, sf):
    return marts.account_changes(staging.account_events(fx.account_log(spark, sf)))


def _scd2(spark, sf, **options):
    return marts.dim_accounts(staging.account_events(fx.account_log(spark, sf), **options), **options)


@query
def scd2_accounts(spark, sf):
    return _scd2(spark, sf)


@query
def scd2_accounts_split(spark, sf):
    return _scd2(spark, sf, policy=SPLIT)


def _as_of(spark, sf, **options):
    facts = fx.facts(spark, sf).select("transaction_id", "from_account_id", "created_at", "amount")
    take = ["version_number", "balance", "valid_from", "valid_to"]
    versions = stored(_scd2(spark, sf), "dim_accounts")
    return history.as_of(facts, versions, "from_account_id", "created_at", take, **options)


@query
def as_of_join(spark, sf):
    return _as_of(spark, sf)


@query
def as_of_join_split(spark, sf):
    return _as_of(spark, sf, policy=SPLIT)


# --- marts -----------------------------------------------------------------------------------


@query
def dim_customers(spark, sf):
    return marts.dim_customers(staging.stg_customers(fx.customer_log(spark, sf)))


@query
def dim_date(spark, sf):
    """Calendar with the number of events of each day."""
    per_day = (
        fx.table(spark, sf, "events")
        .groupBy(sc.date_key(F.col("ts")).alias("date_id"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return calendar.dim_date(spark, ANCHOR).join(per_day, "date_id", "left")


def _fact(spark, sf, accounts, account=None):
    log = fx.transaction_log(spark, sf, account)
    return marts.fact_transactions(staging.stg_transactions(log), accounts)


@query
def fact_transactions(spark, sf):
    return _fact(spark, sf, _scd2(spark, sf))


# --- activity and rules ----------------------------------------------------------------------


def _completed(spark, sf, account=None):
    return activity.completed(fx.facts(spark, sf, account))


def _rolling(spark, sf, **options):
    rows = _completed(spark, sf, _mod10()).select(
        "transaction_id", "from_account_id", "transaction_type", "created_at", "amount"
    )
    return activity.rolling_count(rows, **options).drop("amount", "transaction_type")


@query
def burst_window(spark, sf):
    return _rolling(spark, sf)


@query
def burst_window_split(spark, sf):
    return _rolling(spark, sf, policy=SPLIT)


@query
def account_stats(spark, sf):
    stats = activity.account_stats(_completed(spark, sf))
    return _rounded(stats, "acct_mean_amount", "acct_stddev_amount")


@query
def daily_rate(spark, sf):
    return _rounded(activity.daily_rate(_completed(spark, sf)), "avg_daily_txns")


def _features(spark, sf, **options):
    rows = anomaly.int_txn_features(fx.facts(spark, sf), **options)
    return _rounded(rows, "acct_mean_amount", "acct_stddev_amount", "avg_daily_txns")


@query
def txn_features(spark, sf):
    return _features(spark, sf)


@query
def txn_features_split(spark, sf):
    return _features(spark, sf, policy=SPLIT)


def _rule(code: str, spark, sf, account=None):
    return rules.flags_of(anomaly.completed_with_features(fx.facts(spark, sf, account)), code)


@query
def rule_burst(spark, sf):
    return _rule("BURST_TRANSFER", spark, sf, _mod10())


@query
def rule_high_value(spark, sf):
    return _rule("HIGH_VALUE_OUTLIER", spark, sf)


@query
def rule_dormant(spark, sf):
    return _rule("DORMANT_SPIKE", spark, sf)


def _mart(fact: DataFrame) -> DataFrame:
    return anomaly.mart_suspicious_transactions(fact, F.lit(FLAGGED_AT).cast("timestamp_ntz"))


@query
def mart_suspicious_transactions(spark, sf):
    """All rules on one fact in one pass; some transactions meet two."""
    return _mart(fx.facts(spark, sf, _blended()))


@query
def mart_suspicious_by_user(spark, sf):
    return _mart(fx.facts(spark, sf))


@query
def mart_suspicious_by_mod10(spark, sf):
    return _mart(fx.facts(spark, sf, _mod10()))


@query
def suspicious_transactions(spark, sf):
    """From landing rows to flags, with the marts stored in between."""
    accounts = stored(_scd2(spark, sf), "dim_accounts")
    return _mart(stored(_fact(spark, sf, accounts, _blended()), "fact")).drop("flagged_at")


def _flags(spark, sf):
    return stored(anomaly.flags(fx.facts(spark, sf, _blended())), "flags")


# --- reports ---------------------------------------------------------------------------------


@query
def report_customers(spark, sf):
    customers = marts.dim_customers(staging.stg_customers(fx.customer_log(spark, sf)))
    return reports.customer_count(customers)


@query
def report_scd2(spark, sf):
    return reports.version_statistics(_scd2(spark, sf))


@query
def report_fact_totals(spark, sf):
    return reports.fact_totals(fx.facts(spark, sf))


@query
def report_multi_version(spark, sf):
    return reports.multi_version_accounts(_scd2(spark, sf))


@query
def report_flags_by_rule(spark, sf):
    return reports.flags_by_rule(_flags(spark, sf))


@query
def report_multi_rule(spark, sf):
    return reports.multi_rule_accounts(_flags(spark, sf))


@query
def report_top_burst(spark, sf):
    return reports.top_bursts(_flags(spark, sf))


@query
def report_top_high_value(spark, sf):
    return reports.top_high_values(_flags(spark, sf))


# --- personal data ---------------------------------------------------------------------------


@query
def pseudonymize(spark, sf):
    images = fx.customer_images(spark, sf).drop("o_custkey", "o_orderdate")
    return envelope.hide_personal_columns(images, "customers", fx.SALT)


@query
def keyed_tokens(spark, sf):
    """One key per customer; the keys of customers with a negative balance have been deleted."""
    customer = fx.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name_token"), F.col("c_mktsegment").alias("segment_token")
    )
    keys = (
        fx.table(spark, sf, "customer")
        .filter("c_acctbal >= 0")
        .select("c_custkey", F.sha2(F.col("c_custkey").cast("string"), 256).alias("token_key"))
    )
    return governance.keyed_tokens(customer, keys, "c_custkey", ["name_token", "segment_token"])


# --- ingest ----------------------------------------------------------------------------------


def _topic(spark, sf):
    """The raw messages as a stored topic, so that reading them is separate from making them."""
    return stored(fx.account_messages(spark, sf), "topic")


def _decoded(topic):
    raw = envelope.of_table(topic, "accounts")
    return envelope.decode_json(envelope.drop_tombstones(raw), "accounts")


def _flattened(decoded):
    """Landing rows with some of the before image's values read back from its text."""
    rows = envelope.landing_rows(decoded, "accounts", fx.SALT)
    before = F.from_json("_cdc_before", "account_number string, balance string, status string")
    return rows.withColumn("_b", before).select(
        *[c for c in rows.columns if c != "_cdc_before"],
        F.col("_b.account_number").alias("before_account_number"),
        F.col("_b.balance").alias("before_balance"),
        F.col("_b.status").alias("before_status"),
    )


@query
def envelope_flatten(spark, sf):
    return _flattened(_decoded(_topic(spark, sf)))


@query
def connect_flatten(spark, sf):
    """The same rows from messages of which two thirds have connector-encoded decimals, some below ``payload``."""
    raw = stored(fx.account_messages(spark, sf, "connect"), "topic")
    return _flattened(connect.decode_connect_json(envelope.drop_tombstones(raw), "accounts"))


# Two versions of a writer's schema: the later one sends balances as text and has a field more, in another order.
WRITERS = {
    7: "before STRUCT<{0}, balance: DECIMAL(18,2)>, after STRUCT<{0}, balance: DECIMAL(18,2)>, op STRING, source STRUCT<ts_ms: BIGINT>, ts_ms BIGINT",
    9: "ts_ms BIGINT, op STRING, source STRUCT<ts_ms: BIGINT>, after STRUCT<branch: STRING, balance: STRING, {0}>, before STRUCT<balance: STRING, {0}>",
}
_TEXTS = "account_id account_number account_type currency status created_at updated_at customer_id"
WRITERS = {k: v.format(", ".join(f"{c}: STRING" for c in _TEXTS.split())) for k, v in WRITERS.items()}


@query
def registry_flatten(spark, sf):
    """The same rows from messages in registry wire format, each read by the schema its header names."""
    raw = stored(fx.account_messages(spark, sf, "registry"), "topic")
    decoded = connect.decode_registry(
        envelope.drop_tombstones(raw), "accounts", WRITERS, lambda body, ddl: F.from_json(body.cast("string"), ddl)
    )
    return _flattened(decoded)


@query
def connect_customers(spark, sf):
    """Customers with dates of birth as days since 1970: tokens are those of the dates."""
    raw = stored(fx.customer_messages(spark, sf), "topic")
    rows = envelope.landing_rows(connect.decode_connect_json(raw, "customers"), "customers", fx.SALT)
    return rows.select("customer_id", "date_of_birth", "email", "_cdc_op", "_cdc_ts_ms", "_kafka_offset")


@query
def envelope_dead_letter(spark, sf):
    """Outcome of every message, counted by partition."""
    raw = _topic(spark, sf)
    by_partition = envelope.with_table_name(raw).groupBy("table", "partition")
    arrived = by_partition.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("value").isNull()).alias("tombstones")
    )
    bad = (
        envelope.with_table_name(envelope.dead_letters(_decoded(raw), fx.SALT))
        .groupBy("table", "partition")
        .agg(F.count(F.lit(1)).alias("dead_letters"))
    )
    return arrived.join(bad, ["table", "partition"], "left").na.fill(0, ["dead_letters"])


@query
def dead_letter_rows(spark, sf):
    return envelope.dead_letters(_decoded(_topic(spark, sf)), fx.SALT)


@query
def envelope_to_scd2(spark, sf):
    """Raw messages all the way to account versions."""
    rows = envelope.landing_rows(_decoded(_topic(spark, sf)), "accounts", fx.SALT)
    return marts.dim_accounts(staging.account_events(stored(rows, "landing_accounts")))


def _landed(spark, sf, closed: bool = True) -> str:
    """The account log in a landing zone of its own, as one batch, its hours closed."""
    base = fresh_path(spark, "landing")
    landing.write_rows(envelope.with_partitions(fx.account_log(spark, sf)), base, "accounts")
    if closed:
        landing.close_hours(spark, base, "accounts")
    return base


@query
def landing_partitions(spark, sf):
    """Write the account log to a landing zone, close its hours, read it back, count rows per hour folder."""
    return (
        landing.scan(spark, _landed(spark, sf), "accounts")
        .groupBy("year", "month", "day", "hour")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("balance").cast("decimal(28,2)").alias("balance"))
    )


@query
def landing_pruned(spark, sf):
    """The same landing zone, read for ten days only: other folders are not opened."""
    rows = landing.scan(spark, _landed(spark, sf), "accounts", since="2024-01-05", until="2024-01-14")
    return rows.select("account_id", "balance", "_kafka_offset", "day", "hour")


@query
def landing_manifest(spark, sf):
    """Rows of each closed hour as the manifest states them, after late rows have been closed into their hours."""
    base = fresh_path(spark, "landing")
    rows = envelope.with_partitions(fx.account_log(spark, sf))
    late = F.col("_kafka_offset") % 5 == 0
    for part in (rows.filter(~late), rows.filter(late)):
        landing.write_rows(part, base, "accounts")
        landing.close_hours(spark, base, "accounts")
    return landing.live_hours(spark, base, "accounts").select("year", "month", "day", "hour", F.col("rows").alias("n_rows"))


@query
def schema_reconcile(spark, sf):
    """Files that disagree: other decimal scale, missing column, column without values."""
    base = fresh_path(spark, "foreign")
    images = fx.transaction_images(fx.table(spark, sf, "events")).drop("ts", "event_id")
    transfer = F.col("transaction_type") == "TRANSFER"
    images.filter(transfer).withColumn("amount", F.col("amount").cast("decimal(12,4)")).drop(
        "description"
    ).write.parquet(f"{base}/part=a")
    images.filter(~transfer).drop("to_account_id").withColumn(
        "description", F.lit("payment")
    ).write.parquet(f"{base}/part=b")
    contract = landing_schema("transactions", with_partitions=False)
    wanted = T.StructType([f for f in contract.fields if f.name in images.columns])
    return landing.reconcile(spark, base, wanted)


@query
def stream_ingest(spark, sf):
    """Raw messages through the streaming job, copies removed as in staging."""
    base = fresh_path(spark, "stream")
    raw = fx.account_messages(spark, sf)
    again = raw.filter(F.col("offset") % 7 == 0)
    raw.unionByName(again).write.parquet(f"{base}/messages")
    source = sources.file_stream(spark, f"{base}/messages", files_per_batch=1)
    job = ingest.start_ingest(
        source, "accounts", f"{base}/landing", f"{base}/checkpoint", fx.SALT, "s1", available_now=True
    )
    job.awaitTermination()
    rows = messages.drop_redelivered(landing.scan(spark, f"{base}/landing", "accounts"))
    return rows.select(
        "account_id",
        "account_number",
        "balance",
        "status",
        "_cdc_op",
        "_cdc_ts_ms",
        "_kafka_topic",
        "_kafka_partition",
        "_kafka_offset",
        "year",
        "month",
        "day",
        "hour",
    )


# --- quality ---------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    facts = fx.facts(spark, sf)
    tests = quality.not_null(*facts.columns)
    return quality.run_expectations("facts", facts, tests)


@query
def dq_unique(spark, sf):
    tests = quality.unique("_kafka_offset") + quality.unique("account_id")
    return quality.run_expectations("account_log", fx.account_log(spark, sf), tests)


@query
def dq_accepted_values(spark, sf):
    tests = quality.accepted_values("transaction_type", ["TRANSFER", "DEPOSIT"])
    tests += quality.accepted_values("status", ["COMPLETED", "FAILED"], severity="warn")
    return quality.run_expectations("facts", fx.facts(spark, sf), tests)


@query
def dq_check(spark, sf):
    log = fx.transaction_log(spark, sf)
    accounts = fx.account_log(spark, sf)
    tests = expectations.LANDING_CHECKS
    return quality.run_expectations(
        "transactions", log, tests["transactions"] + quality.check("amount", "amount < 100")
    ).unionByName(quality.run_expectations("accounts", accounts, tests["accounts"]))


@query
def dq_referential(spark, sf):
    log = fx.transaction_log(spark, sf)
    accounts = staging.stg_accounts(fx.account_log(spark, sf))
    customers = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    results = [
        quality.referential("transactions", log, "from_account_id", accounts, "account_id"),
        quality.referential("transactions", log, "to_account_id", accounts, "account_id"),
        quality.referential("accounts", accounts, "customer_id", customers, "id"),
    ]
    return reduce(DataFrame.unionByName, results)


def _landing(spark, sf):
    return {
        "customers": fx.customer_log(spark, sf),
        "accounts": fx.account_log(spark, sf),
        "transactions": fx.transaction_log(spark, sf),
    }


def _models(spark, sf, table=None, **options):
    return build.build_models(
        _landing(spark, sf),
        calendar.dim_date(spark, ANCHOR),
        table=table or (lambda name, rows: stored(rows, name)),
        flagged_at=F.lit(FLAGGED_AT).cast("timestamp_ntz"),
        **options,
    )


@query
def dq_gate(spark, sf):
    """Build all ten models from landing rows, run all tests, pass the gate."""
    return quality.gate(stored(expectations.test_models(_models(spark, sf)), "dq"))


@query
def dq_gate_warnings(spark, sf):
    """The fact's tests as warnings on rows with planted faults: reported, but let through."""
    number = F.col("transaction_id").cast("bigint")
    faulty = fx.facts(spark, sf).withColumns(
        {
            "amount": F.when(number % 97 != 0, F.col("amount")),
            "from_account_id": F.when(number % 89 != 0, F.col("from_account_id")),
            "transaction_type": F.when(number % 83 == 0, "GIFT").otherwise(F.col("transaction_type")),
            "status": F.when(number % 79 == 0, "LOST").otherwise(F.col("status")),
            "transaction_id": F.when(number % 73 == 0, (number + 1).cast("string")).otherwise(F.col("transaction_id")),
        }
    )
    tests = [replace(t, severity="warn") for t in expectations.MODEL_TESTS["fact_transactions"]]
    return quality.gate(stored(quality.run_expectations("fact_transactions", faulty, tests), "dq"))


@query
def mart_tables(spark, sf):
    """Marts written as tables and read back, staging kept as views: rows of each."""
    base = fresh_path(spark, "marts")
    started = martstore.Build(spark, base)
    _models(spark, sf, table=martstore.as_mart(started, build.DEALT), view=build.as_view)
    started.publish()
    counts = [
        build.read_mart(spark, base, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        for name in build.TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def refreshed_facts(spark, sf):
    """Facts after a full build of most rows and a refresh with the rest, late rows of all days among them."""
    base, target = fresh_path(spark, "landing"), fresh_path(spark, "marts")
    logs = _landing(spark, sf)
    late = {"customers": F.col("_kafka_offset") % 9 == 0, "accounts": F.col("_kafka_offset") % 8 == 0, "transactions": F.col("_kafka_offset") % 6 == 0}
    for job in (refresh.full, refresh.refresh):
        for name, rows in logs.items():
            part = rows.filter(late[name] if job is refresh.refresh else ~late[name])
            landing.write_rows(envelope.with_partitions(part), base, name)
        job(spark, base, target)
    return martstore.read_mart(spark, target, "fact_transactions")


@query
def erasure_build(spark, sf):
    """Accounts of the dimension after a rebuild that erases deleted customers."""
    models = _models(spark, sf, drop_deleted=True)
    accounts = models["dim_accounts"].select("account_id", "version_number", "customer_id", "account_number_token")
    known = models["dim_customers"].select(F.col("customer_id").alias("_known"))
    joined = accounts.join(known, F.col("customer_id") == F.col("_known"), "left")
    return joined.select(*accounts.columns, F.col("_known").isNotNull().alias("customer_known"))


# --- retention -------------------------------------------------------------------------------


@query
def retention_expire(spark, sf):
    """Days older than seven years are gone from the landing zone."""
    base = _landed(spark, sf, closed=False)
    governance.expire(spark, base, "accounts", AS_OF)
    rows = landing.scan(spark, base, "accounts")
    return rows.select("account_id", "_cdc_ts_ms", "_kafka_offset", "year", "month", "day")


@query
def retention_policy(spark, sf):
    """The policy table with the rows that each landing table holds."""
    rows = [(name, log.agg(F.count(F.lit(1)).alias("n_rows"))) for name, log in _landing(spark, sf).items()]
    counted = reduce(DataFrame.unionByName, [n.withColumn("dataset", F.lit(name)) for name, n in rows])
    return governance.retention_policy(spark).join(counted, "dataset")


@query
def stream_dedup(spark, sf):
    """Copies removed while streaming."""
    base = fresh_path(spark, "dedup")
    fx.account_log(spark, sf).write.parquet(f"{base}/rows")
    rows = spark.readStream.schema(spark.read.parquet(f"{base}/rows").schema).parquet(f"{base}/rows")
    job = (
        ingest.dedup_stream(rows, "1 day")
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("account_id", "_cdc_ts_ms", "_kafka_partition", "_kafka_offset")


@query
def stream_bursts(spark, sf):
    """Burst flags from the stream: later half landed while the job is down, then a closing heartbeat."""
    base = fresh_path(spark, "bursts")
    rows = fx.facts(spark, sf, _mod10()).select("transaction_id", "from_account_id", "created_at", "transaction_type", "status")
    facts = stored(rows, "facts")
    first, last = facts.agg(F.min("created_at"), F.max("created_at")).first()
    middle = first + (last - first) / 2
    beat = spark.range(1).select(
        F.lit("heartbeat").alias("transaction_id"), F.lit("heartbeat").alias("from_account_id"),
        F.lit(str(last + timedelta(days=1))).cast("timestamp_ntz").alias("created_at"),
        F.lit("TRANSFER").alias("transaction_type"), F.lit("COMPLETED").alias("status"),
    )
    early = F.col("created_at") <= F.lit(str(middle)).cast("timestamp_ntz")
    for part in (facts.filter(early), facts.filter(~early).unionByName(beat)):
        part.write.mode("append").parquet(f"{base}/rows")
        source = spark.readStream.schema(facts.schema).parquet(f"{base}/rows")
        job = bursts.start_flags(source, f"{base}/out", f"{base}/checkpoint", "1 hour", available_now=True)
        job.awaitTermination()
    flags = spark.read.schema(bursts.FLAGS).parquet(f"{base}/out")
    return flags.select("transaction_id", "from_account_id", "created_micros", "transfers_in_2h_window")


@query
def replayed_batches(spark, sf):
    """A batch written twice and late rows in a batch of their own: each row once."""
    base = fresh_path(spark, "replay")
    rows = envelope.with_partitions(fx.account_log(spark, sf).withColumn(envelope.ARRIVED, F.lit(1_704_067_200_000)))
    late = F.col("_kafka_offset") % 5 == 0
    for batch in ("s-0", "s-0"):
        landing.write_rows(rows.filter(~late), base, "accounts", batch)
    landing.write_rows(rows.filter(late), base, "accounts", "s-1")
    return landing.scan(spark, base, "accounts").select("account_id", "_cdc_ts_ms", "_kafka_offset", "hour")


@query
def retention_report(spark, sf):
    day = governance.event_day(F.col("_cdc_ts_ms"))
    sources_ = [
        ("customers", fx.customer_log(spark, sf), "2001-08-01", 90),
        ("accounts", fx.account_log(spark, sf), AS_OF, 7 * 365),
    ]
    return reduce(
        DataFrame.unionByName,
        [governance.retention_report(rows, n, day, as_of, d) for n, rows, as_of, d in sources_],
    )


# --- scalar functions ------------------------------------------------------------------------


@query
def scalar_functions(spark, sf):
    orders = fx.table(spark, sf, "orders")
    at, price = F.col("o_orderdate"), F.col("o_totalprice")
    as_text = F.date_format(at, fx.ISO)
    ms = fx.millis(at)
    back = sc.millis_to_utc(ms)
    return orders.select(
        "o_orderkey",
        sc.md5_key(F.col("o_orderkey"), ms).alias("md5_key"),
        sc.text_token(F.col("o_orderpriority"), fx.SALT).alias("token"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("joined"),
        F.concat("o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("joined_null"),
        price.cast("decimal(18,2)").cast("string").alias("price_text"),
        sc.iso_to_utc(as_text).alias("parsed_ts"),
        F.to_date(as_text).alias("parsed_date"),
        back.alias("from_millis"),
        sc.date_key(at).alias("date_key"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
        F.quarter(at).alias("quarter"),
        (F.dayofweek(at) - 1).alias("day_of_week"),
        F.date_format(at, "EEEE").alias("day_name"),
        F.date_format(at, "MMMM").alias("month_name"),
        (F.weekday(at) >= 5).alias("is_weekend"),
        F.add_months(F.to_date(at), -24).alias("two_years_before"),
        sc.round_double(price / 7.0, 2).alias("rounded"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("?")).alias("status_or_mark"),
        sc.double_text(sc.round_double(price / 3.0, 1), 1).alias("ratio_text"),
        (F.col("o_custkey") * 4 + 2 > F.col("o_orderkey")).alias("compared"),
        F.get_json_object(
            F.to_json(F.struct("o_orderkey", "o_orderstatus")), "$.o_orderstatus"
        ).alias("json_status"),
        sc.last_segment(F.concat(F.lit("bank.public."), "o_orderstatus")).alias("last_part"),
        F.date_format(back, "HH").alias("hour_text"),
    )
