"""SQL that computes each registered query on the same tables, for comparison."""

from __future__ import annotations

SQL: dict[str, str] = {}

# --- ledger-shaped views; passbook/fixtures.py defines the same ------------------------------

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def token(value: str) -> str:
    return f"sha256('test-salt:' || CAST({value} AS VARCHAR))"


ACCOUNT_IMAGES = """
account_images AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         'AC' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS account_number,
         CASE user_id % 3 WHEN 0 THEN 'CHECKING' WHEN 1 THEN 'SAVINGS' ELSE 'BUSINESS' END AS account_type,
         CASE user_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency,
         CAST(floor(value / 25) * 25 AS DECIMAL(18,2)) AS balance,
         CASE event_type WHEN 'error' THEN 'FROZEN' WHEN 'signup' THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
         '2024-01-01T00:00:00Z' AS created_at,
         strftime(ts, {iso}) AS updated_at,
         epoch_us(ts) // 1000 AS ms, event_id, user_id, ts
  FROM events)""".format(iso=ISO)

ACCOUNT_LOG = f"""{ACCOUNT_IMAGES},
account_once AS (
  SELECT * EXCLUDE (account_number, ms, event_id, user_id, ts),
         {token('account_number')} AS account_number,
         CASE WHEN event_id % 50 = 0 THEN 'd' ELSE 'u' END AS _cdc_op,
         ms AS _cdc_ts_ms,
         CAST(user_id % 3 AS INTEGER) AS _kafka_partition,
         event_id AS _kafka_offset
  FROM account_images),
account_log AS (
  SELECT * FROM account_once
  UNION ALL
  SELECT * FROM account_once WHERE _kafka_offset % 7 = 0)"""


def transaction_log(account: str = "user_id", suffix: str = "") -> str:
    return f"""
created{suffix} AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST({account} AS VARCHAR) AS from_account_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN CAST(user_id + 1 AS VARCHAR) END AS to_account_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         'EUR' AS currency,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'TRANSFER' ELSE 'PAYMENT' END AS transaction_type,
         CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
         CAST(NULL AS VARCHAR) AS description,
         strftime(ts, {ISO}) AS created_at,
         'c' AS _cdc_op,
         epoch_us(ts) // 1000 AS _cdc_ts_ms,
         CAST(event_id % 3 AS INTEGER) AS _kafka_partition,
         event_id AS _kafka_offset
  FROM events),
transaction_log{suffix} AS (
  SELECT * FROM created{suffix}
  UNION ALL
  SELECT * FROM created{suffix} WHERE _kafka_offset % 7 = 0
  UNION ALL
  SELECT * REPLACE ('REVERSED' AS status, 'u' AS _cdc_op, _cdc_ts_ms + 1000 AS _cdc_ts_ms,
                    _kafka_offset + 1000000000 AS _kafka_offset)
  FROM created{suffix} WHERE _kafka_offset % 5 = 0)"""


def facts(account: str = "user_id", name: str = "facts") -> str:
    return f"""
{name} AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST({account} AS VARCHAR) AS from_account_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN CAST(user_id + 1 AS VARCHAR) END AS to_account_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         'EUR' AS currency,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'TRANSFER' ELSE 'PAYMENT' END AS transaction_type,
         CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
         CAST(NULL AS VARCHAR) AS description,
         CAST({account} AS VARCHAR) AS from_customer_id,
         ts AS created_at,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id
  FROM events)"""


CUSTOMER_IMAGES = f"""
customer_images AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         c_name || ' ' || o_orderpriority AS last_name,
         lower(replace(c_name, '#', '.')) || '@example.org' AS email,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS national_id,
         DATE '1950-01-01' + CAST(o_custkey % 18000 AS INTEGER) AS date_of_birth,
         '1995-01-01T00:00:00Z' AS created_at,
         strftime(o_orderdate, {ISO}) AS updated_at,
         o_orderkey, o_custkey, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PERSONAL = ["first_name", "last_name", "email", "national_id", "date_of_birth"]

CUSTOMER_LOG = f"""{CUSTOMER_IMAGES},
customer_log AS (
  SELECT customer_id,
         {', '.join(f'{token(c)} AS {c}_token' for c in PERSONAL)},
         created_at, updated_at,
         CASE WHEN o_orderkey % 40 = 0 THEN 'd' ELSE 'u' END AS _cdc_op,
         epoch_us(o_orderdate) // 1000 AS _cdc_ts_ms,
         CAST(o_custkey % 3 AS INTEGER) AS _kafka_partition,
         o_orderkey AS _kafka_offset
  FROM customer_images)"""

# --- models ----------------------------------------------------------------------------------

NEWEST = "_cdc_ts_ms DESC, _kafka_partition DESC, _kafka_offset DESC"
OLDEST = "_cdc_ts_ms, _kafka_partition, _kafka_offset"

STG_CUSTOMERS = f"""
stg_customers AS (
  SELECT * EXCLUDE (_kafka_partition, _kafka_offset)
  FROM customer_log
  WHERE _cdc_op <> 'd'
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {NEWEST}) = 1)"""

DIM_CUSTOMERS = """
dim_customers AS (SELECT * EXCLUDE (_cdc_op, _cdc_ts_ms) FROM stg_customers)"""

STG_ACCOUNTS = """
stg_accounts AS (
  SELECT DISTINCT * RENAME (account_number AS account_number_token)
  FROM account_log
  WHERE _cdc_op <> 'd')"""

CHANGES = f"""
walked AS (
  SELECT *, lag(balance) OVER account AS old_balance, lag(status) OVER account AS old_status
  FROM stg_accounts
  WINDOW account AS (PARTITION BY account_id ORDER BY {OLDEST})),
int_account_changes AS (
  SELECT account_id, customer_id, account_number_token, account_type, currency, balance, status,
         created_at, _cdc_ts_ms AS change_ts_ms, _kafka_partition, _kafka_offset
  FROM walked
  WHERE old_balance IS NULL OR old_balance <> balance OR coalesce(old_status, '') <> status)"""

DIM_ACCOUNTS = """
bounded AS (
  SELECT *, lead(change_ts_ms) OVER account AS closed_ms, row_number() OVER account AS version_number
  FROM int_account_changes
  WINDOW account AS (PARTITION BY account_id ORDER BY change_ts_ms, _kafka_partition, _kafka_offset)),
dim_accounts AS (
  SELECT md5(account_id || '|' || change_ts_ms) AS account_sk,
         account_id, customer_id, account_number_token, account_type, currency, balance, status, created_at,
         make_timestamp(change_ts_ms * 1000) AS valid_from,
         make_timestamp(closed_ms * 1000) AS valid_to,
         closed_ms IS NULL AS is_current,
         CAST(version_number AS BIGINT) AS version_number
  FROM bounded)"""

SCD2 = ",".join([ACCOUNT_LOG, STG_ACCOUNTS, CHANGES, DIM_ACCOUNTS])


def stg_transactions(suffix: str = "") -> str:
    return f"""
stg_transactions{suffix} AS (
  SELECT * EXCLUDE (_cdc_op, _kafka_partition, _kafka_offset)
           REPLACE (CAST(created_at AS TIMESTAMP) AS created_at)
  FROM transaction_log{suffix}
  WHERE _cdc_op IN ('r', 'c')
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {OLDEST}) = 1)"""


def fact(suffix: str = "") -> str:
    return f"""
fact_transactions{suffix} AS (
  SELECT t.transaction_id, t.from_account_id, t.to_account_id, a.customer_id AS from_customer_id,
         t.amount, t.currency, t.transaction_type, t.status, t.description, t.created_at,
         CAST(strftime(t.created_at, '%Y%m%d') AS INTEGER) AS date_id,
         t._cdc_ts_ms AS cdc_ingested_at_ms
  FROM stg_transactions{suffix} t
  LEFT JOIN dim_accounts a ON a.account_id = t.from_account_id AND a.is_current)"""


def activity(source: str, name: str = "activity") -> str:
    """Completed rows of ``source`` with their features."""
    return f"""
{name}_rows AS (SELECT *, CAST(created_at AS DATE) AS on_day FROM {source} WHERE status = 'COMPLETED'),
{name}_account AS (
  SELECT from_account_id, avg(amount) AS acct_mean_amount,
         coalesce(stddev_pop(amount), 0) AS acct_stddev_amount,
         CAST(count(*) AS DOUBLE) / count(DISTINCT on_day) AS avg_daily_txns
  FROM {name}_rows GROUP BY from_account_id),
{name}_day AS (
  SELECT from_account_id, on_day, count(*) AS txns_on_same_day
  FROM {name}_rows GROUP BY from_account_id, on_day),
{name} AS (
  SELECT r.*, acct_mean_amount, acct_stddev_amount, txns_on_same_day, avg_daily_txns,
         CASE WHEN transaction_type = 'TRANSFER' THEN
           count(*) FILTER (WHERE transaction_type = 'TRANSFER') OVER (
             PARTITION BY r.from_account_id ORDER BY created_at
             RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)
         ELSE 0 END AS transfers_in_2h_window
  FROM {name}_rows r
  JOIN {name}_account USING (from_account_id)
  JOIN {name}_day USING (from_account_id, on_day))"""


CARRIED = "transaction_id, from_account_id, from_customer_id, amount, transaction_type, status, created_at"


def burst(name: str = "activity") -> str:
    return f"""
  SELECT {CARRIED}, 'BURST_TRANSFER' AS rule_code,
         transfers_in_2h_window || ' transfers from same account in 2-hour window' AS rule_description,
         CAST(transfers_in_2h_window AS DOUBLE) AS rule_score
  FROM {name} WHERE transaction_type = 'TRANSFER' AND transfers_in_2h_window >= 5"""


def high_value(name: str = "activity") -> str:
    return f"""
  SELECT {CARRIED}, 'HIGH_VALUE_OUTLIER' AS rule_code,
         'Amount ' || amount || ' is ' || round(amount / acct_mean_amount, 1)
           || 'x account mean (' || round(acct_mean_amount, 2) || ')' AS rule_description,
         round(amount / acct_mean_amount, 2) AS rule_score
  FROM {name}
  WHERE acct_mean_amount > 0 AND amount > 4 * acct_mean_amount + 2 * acct_stddev_amount"""


def dormant(name: str = "activity") -> str:
    return f"""
  SELECT {CARRIED}, 'DORMANT_SPIKE' AS rule_code,
         txns_on_same_day || ' transactions on this day vs avg ' || round(avg_daily_txns, 1) || '/day'
           AS rule_description,
         round(txns_on_same_day / avg_daily_txns, 2) AS rule_score
  FROM {name} WHERE txns_on_same_day >= 5 AND txns_on_same_day > 3 * avg_daily_txns"""


BLENDED = "CASE WHEN day(ts) % 10 = user_id % 2 THEN user_id % 2 ELSE user_id END"


def flags(source: str) -> str:
    """Hits of all rules on one fact."""
    parts = "\n  UNION ALL".join([high_value("scored"), dormant("scored"), burst("scored")])
    return f"{activity(source, 'scored')},\nflags AS ({parts})"


FLAGS = ",".join([facts(BLENDED), flags("facts")])
MART = "SELECT md5(transaction_id || '|' || rule_code) AS flag_sk, *, TIMESTAMP '2024-02-01' AS flagged_at FROM flags"

CALENDAR = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date_day,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, monthname(d) AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter, isodow(d) IN (6, 7) AS is_weekend
  FROM range(TIMESTAMP '2022-01-15', TIMESTAMP '2027-01-15', INTERVAL 1 DAY) days(d))"""


def add(name: str, ctes: list[str], body: str) -> None:
    SQL[name] = f"WITH {','.join(ctes)}\n{body}" if ctes else body


# --- messages and staging --------------------------------------------------------------------

add(
    "msg_dedup",
    [ACCOUNT_LOG],
    """SELECT account_id, balance, status, _cdc_op, _cdc_ts_ms, _kafka_partition, _kafka_offset
FROM account_log
QUALIFY row_number() OVER (PARTITION BY _kafka_partition, _kafka_offset) = 1""",
)
add("latest_state_scd1", [CUSTOMER_LOG, STG_CUSTOMERS], "SELECT * FROM stg_customers")
add(
    "latest_state_erasure",
    [
        CUSTOMER_LOG,
        f"""
newest AS (
  SELECT * FROM customer_log
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {NEWEST}) = 1)""",
    ],
    "SELECT * EXCLUDE (_kafka_partition, _kafka_offset) FROM newest WHERE _cdc_op <> 'd'",
)
add("first_event", [transaction_log(), stg_transactions()], "SELECT * FROM stg_transactions")

# --- history ---------------------------------------------------------------------------------

add("stg_accounts", [ACCOUNT_LOG, STG_ACCOUNTS], "SELECT * FROM stg_accounts")
add(
    "account_changes",
    [ACCOUNT_LOG, STG_ACCOUNTS, CHANGES],
    "SELECT * EXCLUDE (_kafka_partition, _kafka_offset) FROM int_account_changes",
)
for key in ("scd2_accounts", "scd2_accounts_split"):
    add(key, [SCD2], "SELECT * FROM dim_accounts")
for key in ("as_of_join", "as_of_join_split"):
    add(
        key,
        [SCD2, facts()],
        """SELECT f.transaction_id, f.from_account_id, f.created_at, f.amount,
       a.version_number, a.balance, a.valid_from, a.valid_to
FROM facts f LEFT JOIN dim_accounts a
  ON a.account_id = f.from_account_id AND a.valid_from <= f.created_at
  AND (a.valid_to IS NULL OR f.created_at < a.valid_to)""",
    )

# --- marts -----------------------------------------------------------------------------------

add("dim_customers", [CUSTOMER_LOG, STG_CUSTOMERS, DIM_CUSTOMERS], "SELECT * FROM dim_customers")
add(
    "dim_date",
    [
        CALENDAR,
        """
per_day AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id, count(*) AS n_events
            FROM events GROUP BY 1)""",
    ],
    "SELECT * FROM dim_date LEFT JOIN per_day USING (date_id)",
)
add(
    "fact_transactions",
    [SCD2, transaction_log(), stg_transactions(), fact()],
    "SELECT * FROM fact_transactions",
)
add(
    "refreshed_facts",
    [SCD2, transaction_log(), stg_transactions(), fact()],
    "SELECT * FROM fact_transactions",
)

# --- activity and rules ----------------------------------------------------------------------

for key in ("burst_window", "burst_window_split"):
    add(
        key,
        [facts("user_id % 10")],
        """SELECT transaction_id, from_account_id, created_at,
       count(*) OVER (PARTITION BY from_account_id ORDER BY created_at
                      RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS transfers_in_2h_window
FROM facts WHERE status = 'COMPLETED' AND transaction_type = 'TRANSFER'""",
    )
add(
    "account_stats",
    [facts()],
    """SELECT from_account_id, round(avg(amount), 6) AS acct_mean_amount,
       round(stddev_pop(amount), 6) AS acct_stddev_amount
FROM facts WHERE status = 'COMPLETED' GROUP BY from_account_id""",
)
add(
    "daily_rate",
    [facts()],
    """SELECT from_account_id,
       round(CAST(count(*) AS DOUBLE) / count(DISTINCT CAST(created_at AS DATE)), 6) AS avg_daily_txns
FROM facts WHERE status = 'COMPLETED' GROUP BY from_account_id""",
)
for key in ("txn_features", "txn_features_split"):
    add(
        key,
        [facts(), activity("facts")],
        """SELECT transaction_id, from_account_id, amount,
       round(acct_mean_amount, 6) AS acct_mean_amount, round(acct_stddev_amount, 6) AS acct_stddev_amount,
       txns_on_same_day, round(avg_daily_txns, 6) AS avg_daily_txns, transfers_in_2h_window
FROM activity""",
    )
add("rule_burst", [facts("user_id % 10"), activity("facts")], burst())
add("rule_high_value", [facts(), activity("facts")], high_value())
add("rule_dormant", [facts(), activity("facts")], dormant())
add("mart_suspicious_transactions", [FLAGS], MART)
add("mart_suspicious_by_user", [facts(), flags("facts")], MART)
add("mart_suspicious_by_mod10", [facts("user_id % 10"), flags("facts")], MART)
add(
    "suspicious_transactions",
    [SCD2, transaction_log(BLENDED), stg_transactions(), fact(), flags("fact_transactions")],
    "SELECT md5(transaction_id || '|' || rule_code) AS flag_sk, * FROM flags",
)

# --- reports: each figure from its definition, not from the statement of the job ------------

add(
    "report_customers",
    [CUSTOMER_LOG],
    """SELECT count(*) AS customers FROM (SELECT DISTINCT customer_id FROM customer_log WHERE _cdc_op <> 'd')""",
)
add(
    "report_scd2",
    [
        SCD2,
        """
per_account AS (
  SELECT account_id, count(*) AS n, bool_or(valid_to IS NULL) AS open FROM dim_accounts GROUP BY account_id)""",
    ],
    """SELECT CAST(sum(n) AS BIGINT) AS total_versions, count(*) AS unique_accounts,
       CAST(nullif(sum(CAST(open AS INTEGER)), 0) AS BIGINT) AS current_versions,
       CAST(nullif(sum(n - CAST(open AS INTEGER)), 0) AS BIGINT) AS historical_versions,
       max(n) AS max_versions_per_account
FROM per_account""",
)
add(
    "report_fact_totals",
    [
        facts(),
        """
pairs AS (
  SELECT DISTINCT transaction_type, status,
         count(*) OVER (PARTITION BY transaction_type, status) AS cnt,
         CAST(sum(amount) OVER (PARTITION BY transaction_type, status) AS DECIMAL(28,2)) AS total_amount
  FROM facts)""",
    ],
    """SELECT * FROM pairs p
WHERE (SELECT count(*) FROM pairs q
       WHERE (-q.cnt, q.transaction_type, q.status) < (-p.cnt, p.transaction_type, p.status)) < 8""",
)
add(
    "report_multi_version",
    [
        SCD2,
        """
several AS (SELECT DISTINCT account_id FROM dim_accounts WHERE version_number = 2),
placed AS (SELECT account_id, rank() OVER (ORDER BY account_id) AS place FROM several)""",
    ],
    """SELECT d.account_id, d.version_number, d.balance, d.status, d.valid_from, d.valid_to IS NULL AS is_current
FROM placed JOIN dim_accounts d USING (account_id) WHERE place <= 3""",
)
add(
    "report_flags_by_rule",
    [
        FLAGS,
        """
of_txn AS (SELECT rule_code, count(*) AS unique_txns FROM (SELECT DISTINCT rule_code, transaction_id FROM flags) GROUP BY 1),
of_account AS (SELECT rule_code, count(*) AS unique_accounts FROM (SELECT DISTINCT rule_code, from_account_id FROM flags) GROUP BY 1),
of_score AS (
  SELECT rule_code, count(*) AS flag_count, min(rule_score) AS low, max(rule_score) AS high, sum(rule_score) / count(*) AS middle
  FROM flags GROUP BY 1)""",
    ],
    """SELECT rule_code, flag_count, unique_txns, unique_accounts, round(low, 2) AS min_score,
       round(middle, 2) AS avg_score, round(high, 2) AS max_score
FROM of_score JOIN of_txn USING (rule_code) JOIN of_account USING (rule_code)""",
)
add(
    "report_multi_rule",
    [
        FLAGS,
        """
pairs AS (SELECT from_account_id, rule_code, count(*) AS n FROM flags GROUP BY ALL),
accounts AS (
  SELECT from_account_id, list_sort(list(rule_code)) AS codes, CAST(sum(n) AS BIGINT) AS total_flags FROM pairs GROUP BY 1),
placed AS (
  SELECT *, row_number() OVER (ORDER BY -len(codes), -total_flags, from_account_id) AS place FROM accounts WHERE len(codes) >= 2)""",
    ],
    """SELECT from_account_id, len(codes) AS rules_fired, total_flags, array_to_string(codes, ', ') AS rules
FROM placed WHERE place <= 10""",
)


def strongest(code: str, columns: str) -> str:
    """The five flags of a rule that fewer than five others beat."""
    return f"""SELECT {columns} FROM flags f WHERE rule_code = '{code}' AND
  (SELECT count(*) FROM flags g WHERE g.rule_code = f.rule_code
   AND (g.rule_score > f.rule_score OR g.rule_score = f.rule_score AND g.transaction_id < f.transaction_id)) < 5"""


add(
    "report_top_burst",
    [FLAGS],
    strongest(
        "BURST_TRANSFER",
        "rule_description, rule_score AS transfers_in_2h, transaction_id, from_account_id, created_at, amount",
    ),
)
add(
    "report_top_high_value",
    [FLAGS],
    strongest("HIGH_VALUE_OUTLIER", "rule_description, rule_score AS amount_vs_mean, transaction_id, amount"),
)

# --- personal data ---------------------------------------------------------------------------

add(
    "pseudonymize",
    [CUSTOMER_IMAGES],
    f"""SELECT customer_id, {', '.join(f'{token(c)} AS {c}' for c in PERSONAL)},
       created_at, updated_at, o_orderkey
FROM customer_images""",
)
add(
    "keyed_tokens",
    [],
    """SELECT c_custkey,
       CASE WHEN c_acctbal >= 0 THEN sha256(sha256(CAST(c_custkey AS VARCHAR)) || ':' || c_name) END AS name_token,
       CASE WHEN c_acctbal >= 0
            THEN sha256(sha256(CAST(c_custkey AS VARCHAR)) || ':' || c_mktsegment) END AS segment_token
FROM customer""",
)

# --- ingest ----------------------------------------------------------------------------------

MESSAGES = f"""{ACCOUNT_IMAGES},
messages AS (
  SELECT *, CASE WHEN event_id % 50 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'c' ELSE 'u' END AS op,
         CASE WHEN event_id % 31 = 1 THEN 'tombstone' WHEN event_id % 37 = 1 THEN 'dead' ELSE 'good' END AS outcome,
         CASE WHEN event_id % 10 = 0 THEN ms + 5 ELSE ms END AS event_ms
  FROM account_images),
landed AS (
  SELECT account_id, customer_id, {token('account_number')} AS account_number, account_type, currency,
         CAST(CASE op WHEN 'd' THEN balance + 1 ELSE balance END AS DECIMAL(18,2)) AS balance,
         status, created_at, updated_at, op AS _cdc_op, event_ms AS _cdc_ts_ms,
         'bank.public.accounts' AS _kafka_topic, CAST(user_id % 3 AS INTEGER) AS _kafka_partition,
         event_id AS _kafka_offset,
         strftime(make_timestamp(event_ms * 1000), '%Y') AS year,
         strftime(make_timestamp(event_ms * 1000), '%m') AS month,
         strftime(make_timestamp(event_ms * 1000), '%d') AS day,
         strftime(make_timestamp(event_ms * 1000), '%H') AS hour,
         CASE WHEN op <> 'c' THEN {token('account_number')} END AS before_account_number,
         CASE WHEN op <> 'c' THEN CAST(CAST(balance + 1 AS DECIMAL(18,2)) AS VARCHAR) END AS before_balance,
         CASE WHEN op <> 'c' THEN status END AS before_status
  FROM messages WHERE outcome = 'good')"""

for same in ("envelope_flatten", "connect_flatten", "registry_flatten"):
    add(same, [MESSAGES], "SELECT * FROM landed")
add(
    "connect_customers",
    [CUSTOMER_IMAGES],
    f"""SELECT customer_id, {token('date_of_birth')} AS date_of_birth, {token('email')} AS email,
       CASE WHEN o_orderkey % 40 = 0 THEN 'd' ELSE 'u' END AS _cdc_op,
       epoch_us(o_orderdate) // 1000 AS _cdc_ts_ms, o_orderkey AS _kafka_offset
FROM customer_images""",
)
add(
    "envelope_dead_letter",
    [MESSAGES],
    """SELECT 'accounts' AS "table", CAST(user_id % 3 AS INTEGER) AS partition, count(*) AS messages,
       count(*) FILTER (WHERE outcome = 'tombstone') AS tombstones,
       count(*) FILTER (WHERE outcome = 'dead') AS dead_letters
FROM messages GROUP BY ALL""",
)
add(
    "dead_letter_rows",
    [MESSAGES],
    """SELECT 'bank.public.accounts' AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset",
       CAST(length(text) AS BIGINT) AS value_length, sha256('test-salt:' || text) AS value_token
FROM (SELECT *, left(CASE op WHEN 'c' THEN '{"after"' ELSE '{"before"' END || ':{"account_id":"' || account_id
                     || '","customer_id":"' || customer_id || '"', 40) AS text
      FROM messages WHERE outcome = 'dead')""",
)
add(
    "envelope_to_scd2",
    [
        MESSAGES,
        """
account_log AS (
  SELECT account_id, customer_id, account_number, account_type, currency, balance, status, created_at,
         updated_at, _cdc_op, _cdc_ts_ms, _kafka_partition, _kafka_offset
  FROM landed)""",
        STG_ACCOUNTS,
        CHANGES,
        DIM_ACCOUNTS,
    ],
    "SELECT * FROM dim_accounts",
)
add(
    "stream_ingest",
    [MESSAGES],
    """SELECT account_id, account_number, balance, status, _cdc_op, _cdc_ts_ms, _kafka_topic,
       _kafka_partition, _kafka_offset, year, month, day, hour
FROM landed""",
)
HOUR_PARTS = """strftime(make_timestamp(_cdc_ts_ms * 1000), '%Y') AS year,
       strftime(make_timestamp(_cdc_ts_ms * 1000), '%m') AS month,
       strftime(make_timestamp(_cdc_ts_ms * 1000), '%d') AS day,
       strftime(make_timestamp(_cdc_ts_ms * 1000), '%H') AS hour"""
add(
    "landing_partitions",
    [ACCOUNT_LOG],
    f"""SELECT {HOUR_PARTS}, count(*) AS n_rows, CAST(sum(balance) AS DECIMAL(28,2)) AS balance
FROM account_log GROUP BY ALL""",
)
add("landing_manifest", [ACCOUNT_LOG], f"SELECT {HOUR_PARTS}, count(*) AS n_rows FROM account_log GROUP BY ALL")
add(
    "landing_pruned",
    [ACCOUNT_LOG],
    """SELECT account_id, balance, _kafka_offset,
       strftime(make_timestamp(_cdc_ts_ms * 1000), '%d') AS day,
       strftime(make_timestamp(_cdc_ts_ms * 1000), '%H') AS hour
FROM account_log
WHERE CAST(make_timestamp(_cdc_ts_ms * 1000) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'""",
)
add(
    "schema_reconcile",
    [facts()],
    """SELECT transaction_id, from_account_id, to_account_id, amount, currency, transaction_type, status,
       CASE transaction_type WHEN 'PAYMENT' THEN 'payment' END AS description
FROM facts""",
)

# --- quality ---------------------------------------------------------------------------------


def result(source: str, model: str, column: str, test: str, failing: str, severity: str = "error") -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test, "
        f"'{severity}' AS severity, {failing} AS failing_rows FROM {source}"
    )


def literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).upper()


def not_null_of(source: str, column: str, severity: str = "error") -> str:
    return result(source, source, column, "not_null", f"count(*) FILTER (WHERE {column} IS NULL)", severity)


def unique_of(source: str, column: str, severity: str = "error") -> str:
    repeated = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    return result(repeated, source, column, "unique", "count(*)", severity)


def accepted_of(source: str, column: str, values: str, severity: str = "error") -> str:
    violated = f"count(*) FILTER (WHERE {column} NOT IN ({values}))"
    return result(source, source, column, "accepted_values", violated, severity)


# The data tests a rebuild must run, written down apart from the library's own list:
# model: columns never null; columns without repeats; columns with their values.
TYPES = "'TRANSFER', 'WITHDRAWAL', 'DEPOSIT', 'PAYMENT'"
STATES = "'COMPLETED', 'PENDING', 'FAILED', 'REVERSED'"
EXPECTED_TESTS = {
    "stg_customers": (
        "customer_id first_name_token last_name_token email_token national_id_token date_of_birth_token _cdc_op",
        "customer_id",
        {},
    ),
    "stg_accounts": (
        "account_id customer_id account_number_token balance status _cdc_ts_ms", "", {"status": "'ACTIVE', 'FROZEN', 'CLOSED'"},
    ),
    "stg_transactions": (
        "transaction_id from_account_id amount", "transaction_id", {"transaction_type": TYPES, "status": STATES},
    ),
    "int_account_changes": ("account_id change_ts_ms balance status", "", {}),
    "dim_customers": ("customer_id first_name_token email_token", "customer_id", {}),
    "dim_accounts": (
        "account_sk account_id customer_id balance status valid_from is_current version_number",
        "account_sk",
        {"status": "'ACTIVE', 'FROZEN', 'CLOSED'", "is_current": "true, false"},
    ),
    "dim_date": ("date_id date_day", "date_id", {}),
    "fact_transactions": (
        "transaction_id from_account_id amount date_id", "transaction_id", {"transaction_type": TYPES, "status": STATES},
    ),
    "int_txn_features": (
        "transaction_id from_account_id transfers_in_2h_window acct_mean_amount txns_on_same_day avg_daily_txns", "", {},
    ),
    "mart_suspicious_transactions": (
        "flag_sk transaction_id rule_code rule_score rule_description from_account_id amount created_at flagged_at",
        "flag_sk",
        {"rule_code": "'BURST_TRANSFER', 'HIGH_VALUE_OUTLIER', 'DORMANT_SPIKE'"},
    ),
}


def tests_of(model: str, severity: str = "error") -> list[str]:
    present, distinct, allowed = EXPECTED_TESTS[model]
    return [
        *(not_null_of(model, c, severity) for c in present.split()),
        *(unique_of(model, c, severity) for c in distinct.split()),
        *(accepted_of(model, c, v, severity) for c, v in allowed.items()),
    ]


FACT_COLUMNS = (
    "transaction_id from_account_id to_account_id amount currency transaction_type status "
    "description from_customer_id created_at date_id"
).split()
UNION = "\nUNION ALL\n"
add(
    "dq_not_null",
    [facts()],
    UNION.join(
        result("facts", "facts", c, "not_null", f"count(*) FILTER (WHERE {c} IS NULL)")
        for c in FACT_COLUMNS
    ),
)
add(
    "dq_unique",
    [ACCOUNT_LOG],
    UNION.join(
        result(
            f"(SELECT {c} FROM account_log GROUP BY {c} HAVING count(*) > 1)",
            "account_log",
            c,
            "unique",
            "count(*)",
        )
        for c in ("_kafka_offset", "account_id")
    ),
)
add(
    "dq_accepted_values",
    [facts()],
    UNION.join(
        [
            result(
                "facts",
                "facts",
                "transaction_type",
                "accepted_values",
                "count(*) FILTER (WHERE transaction_type NOT IN ('TRANSFER', 'DEPOSIT'))",
            ),
            result(
                "facts",
                "facts",
                "status",
                "accepted_values",
                "count(*) FILTER (WHERE status NOT IN ('COMPLETED', 'FAILED'))",
                "warn",
            ),
        ]
    ),
)
def true_of(source: str, model: str, column: str, expression: str) -> str:
    return result(source, model, column, "expression_is_true", f"count(*) FILTER (WHERE NOT ({expression}))")


add(
    "dq_check",
    [transaction_log(), ACCOUNT_LOG],
    UNION.join(
        [
            true_of("transaction_log", "transactions", "amount", "amount > 0"),
            true_of("transaction_log", "transactions", "transaction_type", f"transaction_type IN ({TYPES})"),
            true_of("transaction_log", "transactions", "status", f"status IN ({STATES})"),
            true_of("transaction_log", "transactions", "amount", "amount < 100"),
            true_of("account_log", "accounts", "account_type", "account_type IN ('CHECKING', 'SAVINGS', 'BUSINESS')"),
            true_of("account_log", "accounts", "currency", "currency IN ('EUR', 'USD', 'GBP')"),
            true_of("account_log", "accounts", "status", "status IN ('ACTIVE', 'FROZEN', 'CLOSED')"),
        ]
    ),
)


def orphan_count(child: str, key: str, parent: str, parent_key: str, model: str) -> str:
    return result(
        f"{child} c",
        model,
        key,
        "relationships",
        f"count(*) FILTER (WHERE c.{key} IS NOT NULL AND c.{key} NOT IN "
        f"(SELECT {parent_key} FROM {parent}))",
    )


add(
    "dq_referential",
    [
        transaction_log(),
        ACCOUNT_LOG,
        STG_ACCOUNTS,
        "\nids AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer)",
    ],
    UNION.join(
        [
            orphan_count("transaction_log", "from_account_id", "stg_accounts", "account_id", "transactions"),
            orphan_count("transaction_log", "to_account_id", "stg_accounts", "account_id", "transactions"),
            orphan_count("stg_accounts", "customer_id", "ids", "id", "accounts"),
        ]
    ),
)
ALL_MODELS = [
    CUSTOMER_LOG,
    STG_CUSTOMERS,
    DIM_CUSTOMERS,
    SCD2,
    transaction_log(),
    stg_transactions(),
    fact(),
    CALENDAR,
    activity("fact_transactions", "int_txn_features"),
    f"""
mart_suspicious_transactions AS (
  SELECT md5(transaction_id || '|' || rule_code) AS flag_sk, *, TIMESTAMP '2024-02-01' AS flagged_at
  FROM ({burst('int_txn_features')}
  UNION ALL {high_value('int_txn_features')}
  UNION ALL {dormant('int_txn_features')}))""",
]
add("dq_gate", ALL_MODELS, UNION.join(t for model in EXPECTED_TESTS for t in tests_of(model)))
add(
    "dq_gate_warnings",
    [
        facts(),
        """
fact_transactions AS (
  SELECT * REPLACE (
    CASE WHEN CAST(transaction_id AS BIGINT) % 97 <> 0 THEN amount END AS amount,
    CASE WHEN CAST(transaction_id AS BIGINT) % 89 <> 0 THEN from_account_id END AS from_account_id,
    CASE WHEN CAST(transaction_id AS BIGINT) % 83 = 0 THEN 'GIFT' ELSE transaction_type END AS transaction_type,
    CASE WHEN CAST(transaction_id AS BIGINT) % 79 = 0 THEN 'LOST' ELSE status END AS status,
    CASE WHEN CAST(transaction_id AS BIGINT) % 73 = 0 THEN CAST(CAST(transaction_id AS BIGINT) + 1 AS VARCHAR)
         ELSE transaction_id END AS transaction_id)
  FROM facts)""",
    ],
    UNION.join(tests_of("fact_transactions", "warn")),
)
add(
    "mart_tables",
    ALL_MODELS,
    UNION.join(
        f"SELECT '{m}' AS mart, count(*) AS n_rows FROM {m}"
        for m in ("dim_customers", "dim_accounts", "dim_date", "fact_transactions", "mart_suspicious_transactions")
    ),
)
add(
    "erasure_build",
    [
        CUSTOMER_LOG,
        f"""
newest AS (
  SELECT * FROM customer_log
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {NEWEST}) = 1)""",
        SCD2,
    ],
    """SELECT account_id, version_number,
       CASE WHEN n._cdc_op = 'd' THEN 'erased' ELSE a.customer_id END AS customer_id,
       CASE WHEN n._cdc_op = 'd' THEN 'erased' ELSE account_number_token END AS account_number_token,
       coalesce(n._cdc_op <> 'd', false) AS customer_known
FROM dim_accounts a LEFT JOIN newest n USING (customer_id)""",
)

# --- retention -------------------------------------------------------------------------------

add(
    "retention_expire",
    [ACCOUNT_LOG],
    """SELECT account_id, _cdc_ts_ms, _kafka_offset, strftime(happened, '%Y') AS year,
       strftime(happened, '%m') AS month, strftime(happened, '%d') AS day
FROM (SELECT *, make_timestamp(_cdc_ts_ms * 1000) AS happened FROM account_log)
WHERE happened >= DATE '2031-01-08' - 2555""",
)


def kept(log: str, dataset: str, as_of: str, days: int) -> str:
    limit = f"DATE '{as_of}' - {days}"
    return f"""SELECT '{dataset}' AS dataset, {days} AS keep_days,
       count(*) FILTER (WHERE on_day >= {limit}) AS rows_kept,
       count(*) FILTER (WHERE on_day < {limit}) AS rows_expired, min(on_day) AS oldest_day
FROM (SELECT CAST(make_timestamp(_cdc_ts_ms * 1000) AS DATE) AS on_day FROM {log})"""


add(
    "retention_policy",
    [CUSTOMER_LOG, ACCOUNT_LOG, transaction_log()],
    """SELECT dataset, CAST(keep_days AS INTEGER) AS keep_days, keep_days * 86400000 AS keep_ms, n_rows
FROM (SELECT 'customers' AS dataset, 90::BIGINT AS keep_days, count(*) AS n_rows FROM customer_log
      UNION ALL SELECT 'accounts', 2555, count(*) FROM account_log
      UNION ALL SELECT 'transactions', 2555, count(*) FROM transaction_log)""",
)
add(
    "stream_dedup",
    [ACCOUNT_LOG],
    "SELECT account_id, _cdc_ts_ms, _kafka_partition, _kafka_offset FROM account_once",
)
add(
    "stream_bursts",
    [facts("user_id % 10")],
    """SELECT transaction_id, from_account_id, epoch_us(created_at) AS created_micros, transfers_in_2h_window
FROM (SELECT *, count(*) OVER (PARTITION BY from_account_id ORDER BY created_at
                               RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS transfers_in_2h_window
      FROM facts WHERE status = 'COMPLETED' AND transaction_type = 'TRANSFER')
WHERE transfers_in_2h_window >= 5""",
)
add(
    "replayed_batches",
    [ACCOUNT_LOG],
    "SELECT account_id, _cdc_ts_ms, _kafka_offset, strftime(make_timestamp(_cdc_ts_ms * 1000), '%H') AS hour FROM account_log",
)
add(
    "retention_report",
    [CUSTOMER_LOG, ACCOUNT_LOG],
    UNION.join(
        [
            kept("customer_log", "customers", "2001-08-01", 90),
            kept("account_log", "accounts", "2031-01-08", 2555),
        ]
    ),
)

# --- scalar functions ------------------------------------------------------------------------

add(
    "scalar_functions",
    [],
    f"""SELECT o_orderkey,
       md5(o_orderkey || '|' || (epoch_us(o_orderdate) // 1000)) AS md5_key,
       {token('o_orderpriority')} AS token,
       o_orderstatus || '/' || o_orderpriority AS joined,
       o_orderstatus || nullif(o_orderpriority, '5-LOW') AS joined_null,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
       CAST(strftime(o_orderdate, {ISO}) AS TIMESTAMP) AS parsed_ts,
       CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed_date,
       make_timestamp(epoch_us(o_orderdate) // 1000 * 1000) AS from_millis,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(dayofweek(o_orderdate) AS INTEGER) AS day_of_week,
       dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
       isodow(o_orderdate) IN (6, 7) AS is_weekend,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 YEAR AS DATE) AS two_years_before,
       round(o_totalprice / 7.0::DOUBLE, 2) AS rounded,
       coalesce(nullif(o_orderstatus, 'P'), '?') AS status_or_mark,
       CAST(round(o_totalprice / 3.0::DOUBLE, 1) AS VARCHAR) AS ratio_text,
       o_custkey * 4 + 2 > o_orderkey AS compared,
       o_orderstatus AS json_status, o_orderstatus AS last_part,
       strftime(o_orderdate, '%H') AS hour_text
FROM orders""",
)
