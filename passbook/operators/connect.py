"""Values as connectors encode them, and messages in registry wire format.

A connector with precise decimals sends the unscaled number as bytes (two's complement, most significant
byte first; base64 in JSON) and a date as days since 1970. With schemas switched on, its JSON wraps the
envelope into ``{"schema": …, "payload": …}``. A registry serialiser puts a zero byte and the four-byte id of
the writer's schema before each message. All are read here by column expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.contracts import LONG, SOURCE_TABLES, STR, envelope_schema
from passbook.operators.envelope import UNPARSED, parsed_once

BASE64 = r"^[A-Za-z0-9+/]+={0,2}$"
DAYS = r"^-?[0-9]{1,7}$"
HEADER_BYTES = 5
_WIDE = "decimal(20,0)"


def twos_complement(value: Column) -> Column:
    """The number of 1 to 16 bytes, as decimal(38,0); null for other lengths and beyond 38 digits."""
    digits = F.hex(value)
    fill = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    padded = F.lpad(digits, F.lit(32), fill)
    high = F.conv(F.substring(padded, 1, 16), 16, -10).cast(_WIDE)
    low = F.conv(F.substring(padded, 17, 16), 16, 10).cast(_WIDE)
    # of a negative number, count down from the next multiple above: no step leaves the type's range
    word, below = F.lit(str(2**64)).cast(_WIDE), (high < 0).cast("int").cast(_WIDE)
    whole = F.try_add(F.try_multiply((high + below).cast(_WIDE), word), (low - below * word).cast("decimal(38,0)"))
    return F.when(F.length(value).between(1, 16), whole.cast("decimal(38,0)"))


def connect_decimal(text: Column, kind: T.DecimalType) -> Column:
    """A decimal of scale ``kind.scale`` from its text or from base64 of its bytes; null if it is neither.

    Plain text of such a number has a point, which base64 has not (scales above 0), or a sign.
    """
    step = F.lit(1).cast(f"decimal({kind.scale + 1},{kind.scale})") / F.lit(10**kind.scale)
    step = step.cast(f"decimal({kind.scale + 1},{kind.scale})")
    encoded = text.rlike(BASE64) & (F.length(text) % 4 == 0)
    exact = F.try_multiply(twos_complement(F.try_to_binary(text, F.lit("base64"))), step)
    return F.when(encoded, exact.try_cast(kind)).otherwise(text.try_cast(kind))


def connect_date(text: Column) -> Column:
    """A date from its ISO text or from the number of days since 1970."""
    days = F.date_add(F.lit("1970-01-01").cast("date"), text.try_cast("int"))
    return F.when(text.rlike(DAYS), days).otherwise(text.try_cast("date"))


def _as_sent(kind: T.DataType) -> T.DataType:
    return STR if isinstance(kind, (T.DecimalType, T.DateType)) else kind


def _value(sent: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return connect_decimal(sent, kind)
    return connect_date(sent) if isinstance(kind, T.DateType) else sent


def decode_connect_json(messages: DataFrame, table: str) -> DataFrame:
    """Add ``envelope`` and ``undecodable`` to JSON messages with connector-encoded decimals and dates.

    The envelope may stand alone or below ``payload``. Messages whose decimals and dates are plain text are read too.
    A value that is neither makes the message undecodable.
    """
    fields = SOURCE_TABLES[table].fields
    image = T.StructType([T.StructField(f.name, _as_sent(f.dataType)) for f in fields])
    body = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", STR),
            T.StructField("source", T.StructType([T.StructField("ts_ms", LONG)])),
            T.StructField("ts_ms", LONG),
        ]
    )
    schema = T.StructType([*body.fields, T.StructField("payload", body), T.StructField(UNPARSED, STR)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSED}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)

    def envelope(e: Column) -> Column:
        bare = F.struct(*(e[f.name].alias(f.name) for f in body.fields))
        return F.when(e["payload"].isNotNull(), e["payload"]).otherwise(bare)

    def converted(side: Column) -> Column:
        return F.struct(*(_value(side[f.name], f.dataType).alias(f.name) for f in fields))

    def lost(side: Column) -> Column:
        odd = [side[f.name].isNotNull() & _value(side[f.name], f.dataType).isNull() for f in fields if _as_sent(f.dataType) != f.dataType]
        return reduce(lambda a, b: a | b, odd, F.lit(False))

    def whole(e: Column) -> Column:
        body_ = envelope(e)
        bad = e.isNull() | e[UNPARSED].isNotNull() | lost(body_["before"]) | lost(body_["after"])
        return F.struct(
            converted(body_["before"]).alias("before"),
            converted(body_["after"]).alias("after"),
            body_["op"].alias("op"),
            body_["source"].alias("source"),
            body_["ts_ms"].alias("ts_ms"),
            bad.alias("_bad"),
        )

    # a step of its own, so that the text is parsed once and converted once
    one = messages.select("*", F.explode(F.transform(F.array(parsed), whole)).alias("_whole"))
    found = parsed_once(one, F.col("_whole"), table, lambda e: e["_bad"])
    return found.drop("_whole")


# --- registry wire format --------------------------------------------------------------------


def registry_id(value: Column) -> Column:
    """Id of the writer's schema; null if the header is not a registry's."""
    header = F.hex(F.substring(value, 1, HEADER_BYTES))
    known = (F.length(value) > HEADER_BYTES) & header.startswith("00")
    return F.when(known, F.conv(F.substring(header, 3, 8), 16, 10).cast("bigint"))


def registry_body(value: Column) -> Column:
    """What follows the header."""
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value))


def avro_reader(body: Column, schema: str) -> Column:
    """Needs Spark's ``spark-avro`` module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, schema, {"mode": "PERMISSIVE"})


def _contract_envelope(read: Column, kind: T.DataType, table: str) -> Column:
    """A writer's envelope as the contract's, field by field by name; fields it lacks are null."""

    def adapt(value: Column, have: T.DataType, want: T.DataType) -> Column:
        if isinstance(want, T.StructType):
            if not isinstance(have, T.StructType):
                return F.lit(None).cast(want)
            own = {f.name: f.dataType for f in have.fields}
            parts = [
                (adapt(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in want.fields
            ]
            return F.when(value.isNotNull(), F.struct(*parts))
        if isinstance(have, T.BinaryType) and isinstance(want, T.DecimalType):
            step = F.lit(f"{10.0 ** -want.scale:.{want.scale}f}").cast(f"decimal({want.scale + 1},{want.scale})")
            return F.try_multiply(twos_complement(value), step).try_cast(want)
        if isinstance(have, (T.IntegerType, T.LongType)) and isinstance(want, T.DateType):
            return F.date_add(F.lit("1970-01-01").cast("date"), value.cast("int"))
        return value if have == want else value.try_cast(want)

    return adapt(read, kind, envelope_schema(table))


def decode_registry(
    messages: DataFrame,
    table: str,
    schemas: dict[int, str],
    reader: Callable[[Column, str], Column] = avro_reader,
) -> DataFrame:
    """Add ``envelope`` and ``undecodable`` to messages in registry wire format.

    ``schemas`` holds the writers' schemas by registry id; each message is read with the one its header names and
    then brought to the contract by field name, so messages written before and after a change of the schema land
    alike. A foreign header or an id that is not in ``schemas`` makes a message undecodable: it can be replayed
    when the id is known. Bind ``schemas`` to pass this as ``decode``.
    """
    value = F.col("value").cast("binary")
    body = registry_body(value)
    none = F.lit(None).cast(envelope_schema(table))
    parsed = none
    for number, schema in sorted(schemas.items()):
        read = reader(body, schema)
        kind = messages.select(read.alias("read")).schema["read"].dataType
        parsed = F.when(registry_id(value) == number, _contract_envelope(read, kind, table)).otherwise(parsed)
    return parsed_once(messages, parsed, table, lambda e: e.isNull() | e["op"].isNull())
