"""Table contracts: column types, allowed values, personal-data policy, retention policy.

One ``StructType`` per table is declared here, written by the ingest job and used again by
every reader, so no job infers a schema from files.
"""

from __future__ import annotations

from pyspark.sql import types as T

STR, LONG, INT, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Row images as they arrive inside a change envelope.
SOURCE_TABLES: dict[str, T.StructType] = {
    "customers": _struct(
        customer_id=STR,
        first_name=STR,
        last_name=STR,
        email=STR,
        national_id=STR,
        date_of_birth=DATE,
        created_at=STR,
        updated_at=STR,
    ),
    "accounts": _struct(
        account_id=STR,
        customer_id=STR,
        account_number=STR,
        account_type=STR,
        currency=STR,
        balance=MONEY,
        status=STR,
        created_at=STR,
        updated_at=STR,
    ),
    "transactions": _struct(
        transaction_id=STR,
        from_account_id=STR,
        to_account_id=STR,
        amount=MONEY,
        currency=STR,
        transaction_type=STR,
        status=STR,
        description=STR,
        created_at=STR,
    ),
}

LINEAGE = _struct(
    _cdc_op=STR,
    _cdc_ts_ms=LONG,
    _cdc_before=STR,
    _kafka_topic=STR,
    _kafka_partition=INT,
    _kafka_offset=LONG,
)

# Kept as text so that "07" stays "07"; filters on them still prune directories.
PARTITIONS = _struct(year=STR, month=STR, day=STR, hour=STR)
PARTITION_COLUMNS = PARTITIONS.fieldNames()

# Columns holding personal data, replaced by tokens before landing.
PERSONAL_COLUMNS: dict[str, list[str]] = {
    "customers": ["first_name", "last_name", "email", "national_id", "date_of_birth"],
    "accounts": ["account_number"],
}

# Allowed values of the coded columns.
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "BUSINESS"]
CURRENCIES = ["EUR", "USD", "GBP"]
ACCOUNT_STATUSES = ["ACTIVE", "FROZEN", "CLOSED"]
TRANSACTION_TYPES = ["TRANSFER", "WITHDRAWAL", "DEPOSIT", "PAYMENT"]
TRANSACTION_STATUSES = ["COMPLETED", "PENDING", "FAILED", "REVERSED"]
RULE_CODES = ["BURST_TRANSFER", "HIGH_VALUE_OUTLIER", "DORMANT_SPIKE"]

# Days each landing table is kept (seven years of 365 days; ninety days).
RETENTION_DAYS: dict[str, int] = {"transactions": 7 * 365, "accounts": 7 * 365, "customers": 90}


def envelope_schema(table: str) -> T.StructType:
    image = SOURCE_TABLES[table]
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", STR),
            T.StructField("source", _struct(ts_ms=LONG)),
            T.StructField("ts_ms", LONG),
        ]
    )


def landing_schema(table: str, with_partitions: bool = True) -> T.StructType:
    """Columns of a landing file: tokenised row image, lineage, partition columns."""
    hidden = PERSONAL_COLUMNS.get(table, [])
    image = [
        T.StructField(f.name, STR if f.name in hidden else f.dataType)
        for f in SOURCE_TABLES[table].fields
    ]
    tail = PARTITIONS.fields if with_partitions else []
    return T.StructType(image + LINEAGE.fields + tail)
