"""Column expressions shared by the jobs. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_token(value: Column, salt: str | Column) -> Column:
    """Hex SHA-256 of ``salt:value``; null stays null because ``concat`` propagates it."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.sha2(F.concat(salt, F.lit(":"), value.cast("string")), 256)


def md5_key(*parts: Column) -> Column:
    """Surrogate key: MD5 of the parts joined by ``|``; null if any part is null."""
    joined = [parts[0].cast("string")]
    for part in parts[1:]:
        joined += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*joined))


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def millis_to_utc(millis: Column) -> Column:
    """Epoch milliseconds as a zone-less UTC timestamp, whatever the session's zone."""
    return F.timestamp_add("MILLISECOND", millis, _epoch())


def utc_micros(ts: Column) -> Column:
    """Zone-less UTC timestamp as epoch microseconds, whatever the session's zone."""
    seconds = (ts.cast("timestamp_ntz") - _epoch()).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def iso_to_utc(text: Column) -> Column:
    """ISO text ending in ``Z`` as a zone-less UTC timestamp."""
    return text.cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    return F.year(day) * 10_000 + F.month(day) * 100 + F.day(day)


def last_segment(dotted: Column) -> Column:
    return F.substring_index(dotted, ".", -1)


def round_double(value: Column, digits: int) -> Column:
    """Round the scaled double half away from zero, then scale back.

    ``F.round`` on a double goes through its decimal text, which gives 1.01 for 1.005; scaling
    first gives 1.0, the result column stores use for doubles.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def double_text(value: Column, digits: int) -> Column:
    """Plain text of a double already rounded to ``digits`` (never exponent notation)."""
    fixed = value.cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def any_set(columns: list[Column]) -> Column:
    """True when at least one column is not null."""
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])
