"""Change messages to landing rows.

Message columns are those of a Kafka source: ``topic, partition, offset, value``. Everything is a
column expression, so the same functions serve batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.contracts import PERSONAL_COLUMNS, SOURCE_TABLES, envelope_schema
from passbook.functions.scalars import any_set, last_segment, millis_to_utc, text_token

UNPARSED = "_unparsed"
ARRIVED = "_arrived_ms"


def drop_tombstones(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("value").isNotNull())


def with_table_name(messages: DataFrame) -> DataFrame:
    return messages.withColumn("table", last_segment(F.col("topic")))


def of_table(messages: DataFrame, table: str) -> DataFrame:
    """Messages whose topic ends in ``table``."""
    return messages.filter(last_segment(F.col("topic")) == table)


def parsed_once(messages: DataFrame, parsed: Column, table: str, unreadable) -> DataFrame:
    """Add ``envelope`` and ``undecodable`` from a parse expression.

    The parse runs below an ``explode`` of one element: the optimizer copies a plain column's
    expression into every filter and column that uses it, and would parse each message many times.
    An image without any value counts as absent.
    """
    names = SOURCE_TABLES[table].fieldNames()

    def image(e: Column, side: str) -> Column:
        return F.when(any_set([e[side][n] for n in names]), e[side]).alias(side)

    def tidy(e: Column) -> Column:
        envelope = F.struct(
            image(e, "before"),
            image(e, "after"),
            e["op"].alias("op"),
            e["source"].alias("source"),
            e["ts_ms"].alias("ts_ms"),
        )
        return F.struct(envelope.alias("envelope"), unreadable(e).alias("undecodable"))

    one = F.explode(F.transform(F.array(parsed), tidy)).alias("_one")
    return messages.select("*", one).select(*messages.columns, "_one.envelope", "_one.undecodable")


def decode_json(messages: DataFrame, table: str) -> DataFrame:
    """Add ``envelope`` and ``undecodable`` to messages whose value is JSON text."""
    schema = T.StructType(
        [*envelope_schema(table).fields, T.StructField(UNPARSED, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSED}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)
    return parsed_once(
        messages, parsed, table, lambda e: e.isNull() | e[UNPARSED].isNotNull()
    )


def _letter_columns(salt: str) -> list[Column]:
    value = F.col("value").cast("string")
    return [
        "topic",
        "partition",
        "offset",
        F.length(value).cast("bigint").alias("value_length"),
        text_token(value, salt).alias("value_token"),
    ]


def dead_letters(decoded: DataFrame, salt: str) -> DataFrame:
    """Position, length and token of undecodable messages.

    What cannot be decoded cannot be tokenised column by column either, so the value itself, personal
    data included, stays in the topic; position and token find and compare it there.
    """
    return decoded.filter("undecodable").select(*_letter_columns(salt))


def decoded_only(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col("undecodable")).drop("undecodable")


def hide_personal_data(
    decoded: DataFrame,
    table: str,
    salt: str | Column,
    policy: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Replace personal columns by tokens in both row images of the envelope."""
    hidden = (PERSONAL_COLUMNS if policy is None else policy).get(table, [])

    def tokenised(image: str) -> Column:
        whole = F.col(f"envelope.{image}")
        hashed = whole
        for name in hidden:
            hashed = hashed.withField(name, text_token(F.col(f"envelope.{image}.{name}"), salt))
        return F.when(whole.isNotNull(), hashed)

    if not hidden:
        return decoded
    return decoded.withColumn(
        "envelope",
        F.col("envelope").withField("before", tokenised("before")).withField(
            "after", tokenised("after")
        ),
    )


def hide_personal_columns(
    rows: DataFrame, table: str, salt: str, policy: dict[str, list[str]] | None = None
) -> DataFrame:
    """The same policy for flat rows."""
    hidden = (PERSONAL_COLUMNS if policy is None else policy).get(table, [])
    present = [c for c in hidden if c in rows.columns]
    return rows.withColumns({c: text_token(F.col(c), salt) for c in present})


def event_millis() -> Column:
    """Source time, else envelope time; a zero source time counts as missing."""
    return F.coalesce(
        F.nullif(F.col("envelope.source.ts_ms"), F.lit(0)), F.col("envelope.ts_ms")
    )


def flatten(decoded: DataFrame, table: str, *more: Column) -> DataFrame:
    """One landing row per envelope: the after image (before image for deletes), lineage, and ``more`` columns."""
    names = SOURCE_TABLES[table].fieldNames()
    columns = [
        F.when(F.col("envelope.after").isNotNull(), F.col(f"envelope.after.{n}"))
        .otherwise(F.col(f"envelope.before.{n}"))
        .alias(n)
        for n in names
    ]
    # decimals and dates as text, nulls written out: a reader gets every column back exactly
    before_text = F.to_json(
        F.struct(*[F.col(f"envelope.before.{n}").cast("string").alias(n) for n in names]),
        {"ignoreNullFields": "false"},
    )
    return decoded.select(
        *columns,
        F.coalesce(F.col("envelope.op"), F.lit("")).alias("_cdc_op"),
        event_millis().alias("_cdc_ts_ms"),
        F.when(F.col("envelope.before").isNotNull(), before_text).alias("_cdc_before"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").cast("int").alias("_kafka_partition"),
        F.col("offset").cast("bigint").alias("_kafka_offset"),
        # when the broker took the message: files a row without event time, the same way on a replay
        *([F.unix_millis("timestamp").alias(ARRIVED)] if "timestamp" in decoded.columns else []),
        *more,
    )


def with_partitions(landing: DataFrame) -> DataFrame:
    """Add year, month, day, hour in UTC: of the event time, else of the message's arrival.

    The wall clock is left for rows that have neither.
    """
    event = F.nullif(F.col("_cdc_ts_ms"), F.lit(0))
    if ARRIVED in landing.columns:
        event = F.coalesce(event, F.col(ARRIVED))
    at = millis_to_utc(F.coalesce(event, F.unix_millis(F.current_timestamp())))
    pieces = {"year": (F.year, 4), "month": (F.month, 2), "day": (F.day, 2), "hour": (F.hour, 2)}
    padded = {k: F.lpad(part(at).cast("string"), width, "0") for k, (part, width) in pieces.items()}
    return landing.withColumns(padded).drop(ARRIVED)


def with_subject_key(decoded: DataFrame, keys: DataFrame, subject: str = "customer_id") -> DataFrame:
    """Add ``_secret``, the key of the person a row is about; null if the key does not exist or was deleted.

    ``keys`` holds (subject, token_key). It grows with the bank, so nothing is forced to be broadcast.
    """
    person = F.coalesce(F.col(f"envelope.after.{subject}"), F.col(f"envelope.before.{subject}"))
    secrets = keys.select(F.col(subject).alias("_subject"), F.col("token_key").alias("_secret"))
    return decoded.withColumn("_person", person).join(secrets, F.col("_person") == F.col("_subject"), "left")


def landing_rows(decoded: DataFrame, table: str, salt: str, keys: DataFrame | None = None) -> DataFrame:
    """Decoded messages → tokenised, flattened rows with partition columns.

    With ``keys``, tables that hold personal data are tokenised under each person's own key in place of the
    salt: deleting the key makes that person's tokens meaningless.
    """
    rows = decoded_only(decoded)
    secret: str | Column = salt
    if keys is not None and PERSONAL_COLUMNS.get(table):
        rows, secret = with_subject_key(rows, keys), F.col("_secret")
    return with_partitions(flatten(hide_personal_data(rows, table, secret), table))


def outcomes(decoded: DataFrame, table: str, salt: str, keys: DataFrame | None = None) -> DataFrame:
    """Every decoded message as a landing row, with its dead letter in ``letter`` if it could not be decoded.

    Nothing in it is clear personal data, so it may be written down for the two sinks that read it.
    """
    clean = decoded.withColumn("envelope", F.when(~F.col("undecodable"), F.col("envelope")))
    secret: str | Column = salt
    if keys is not None and PERSONAL_COLUMNS.get(table):
        clean, secret = with_subject_key(clean, keys), F.col("_secret")
    letter = F.when(F.col("undecodable"), F.struct(*_letter_columns(salt))).alias("letter")
    return with_partitions(flatten(hide_personal_data(clean, table, secret), table, letter))
