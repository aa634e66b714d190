"""Recoverable dead letters: undecodable messages, encrypted under keys with a life of their own.

A dead letter's value may hold personal data anywhere, so it is kept only in encrypted form. Each day of arrival has a
key of its own in a key table outside the landing zone. Deleting a day's key makes its letters unreadable
wherever copies of them lie, so their retention is that of the keys. Once the cause is mended, for instance
a new schema known, ``replay`` decodes them again and lands what can be read now.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.functions.scalars import millis_to_utc

KEY_BYTES = 32
#: What an encrypted letter carries in the clear.
POSITION = ["topic", "partition", "offset"]


def arrival_day(timestamp: Column) -> Column:
    """Day of arrival in UTC, whatever the session's zone; letters without arrival share the day 1970-01-01."""
    return F.to_date(millis_to_utc(F.coalesce(F.unix_millis(timestamp), F.lit(0).cast("bigint"))))


def new_keys(days: DataFrame, day: str = "day") -> DataFrame:
    """A random key for each distinct day. Write the result down at once: computed again, it differs."""
    random = F.unhex(F.concat(*(F.replace(F.expr("uuid()"), F.lit("-")) for _ in range(KEY_BYTES // 16))))
    return days.select(F.col(day).cast("date").alias("day")).distinct().withColumn("letter_key", random)


def missing_days(decoded: DataFrame, keys: DataFrame) -> DataFrame:
    """Days of undecodable messages for which there is no key yet."""
    days = decoded.filter("undecodable").select(arrival_day(F.col("timestamp")).alias("day")).distinct()
    return days.join(keys.select("day"), "day", "left_anti")


def encrypted_letters(decoded: DataFrame, keys: DataFrame) -> DataFrame:
    """Undecodable messages: position, arrival and the value encrypted under its day's key.

    The position is authenticated with the value, so a letter cannot be passed off as another one. Without a key for
    its day a letter keeps no value at all. One key a day: the key table is small and grows with the days.
    """
    bad = decoded.filter("undecodable").withColumn("_day", arrival_day(F.col("timestamp")))
    joined = bad.join(keys.select(F.col("day").alias("_key_day"), "letter_key"), F.col("_day") == F.col("_key_day"), "left")
    drawn = F.lit(b"")  # an empty start value has a random one drawn
    value = F.aes_encrypt(F.col("value").cast("binary"), F.col("letter_key"), F.lit("GCM"), F.lit("DEFAULT"), drawn, _bound())
    return joined.select(*POSITION, "timestamp", F.when(F.col("letter_key").isNotNull(), value).alias("sealed"))


def _bound() -> Column:
    return F.concat_ws("|", *(F.col(c).cast("string") for c in POSITION)).cast("binary")


def opened_letters(letters: DataFrame, keys: DataFrame) -> DataFrame:
    """The messages again, as far as their keys exist; what a wrong key or a changed letter gives is left out."""
    days = letters.withColumn("_day", arrival_day(F.col("timestamp")))
    joined = days.join(keys.select(F.col("day").alias("_key_day"), "letter_key"), F.col("_day") == F.col("_key_day"))
    value = F.try_aes_decrypt(F.col("sealed"), F.col("letter_key"), F.lit("GCM"), F.lit("DEFAULT"), _bound())
    return joined.withColumn("value", value).filter("value is not null").select(*POSITION, "value", "timestamp")


def replay(
    letters: DataFrame,
    keys: DataFrame,
    decode: Callable[[DataFrame, str], DataFrame],
    table: str,
    text: bool = True,
) -> DataFrame:
    """Decode letters again: all of them with ``envelope`` and ``undecodable``, as ``decode`` gives them.

    ``text`` says that the decoder reads text. Land the decodable ones with ``ingest.ingest_batch`` under a batch
    name of their own: a letter replayed twice has its position twice, and the models drop such copies.
    """
    messages = opened_letters(letters, keys)
    if text:
        messages = messages.withColumn("value", F.col("value").cast(T.StringType()))
    return decode(messages, table)
