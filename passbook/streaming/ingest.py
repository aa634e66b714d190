"""Ingest job: raw change messages → landing zone and dead letters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from passbook.contracts import SOURCE_TABLES
from passbook.operators.envelope import (
    decode_json,
    drop_tombstones,
    of_table,
    outcomes,
)
from passbook.sources.landing import BATCH, table_path, write_rows
from passbook.workspace import scratch

DEAD_LETTERS = "_dead_letters"


def ingest_batch(
    messages: DataFrame,
    table: str,
    base: str,
    salt: str,
    decode=decode_json,
    keys: DataFrame | None = None,
    batch: str | None = None,
) -> None:
    """Add the rows of one table, and its dead letters, to the landing zone as one batch.

    Messages are read and decoded once, by all cores, into a table of tokenised rows from which both sinks are
    written. Dead letters come first: when the rows are published, the batch is complete. A named ``batch``
    may be repeated (see ``landing.write_rows``).
    """
    batch = batch or uuid.uuid4().hex
    found = outcomes(decode(spread(drop_tombstones(of_table(messages, table))), table), table, salt, keys)
    with scratch(found, "ingest") as rows:
        write_dead_letters(rows.filter("letter is not null").select("letter.*"), base, table, batch)
        write_rows(rows.filter("letter is null").drop("letter"), base, table, batch)


def spread(messages: DataFrame) -> DataFrame:
    """The messages dealt evenly to as many tasks as there are cores, or more if the source has more parts.

    A batch may be one file of one row group, or one busy topic partition, which a single task reads. Rows are dealt
    by their place, which is the same when they are read again, so copies of a message are spread as well.
    """
    tasks = max(messages.sparkSession.sparkContext.defaultParallelism, messages.rdd.getNumPartitions())
    return messages.repartition(tasks, F.monotonically_increasing_id())


def write_dead_letters(letters: DataFrame, base: str, table: str, batch: str) -> None:
    (
        letters.withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(table_path(f"{base}/{DEAD_LETTERS}", table))
    )


def start_ingest(
    messages: DataFrame,
    table: str,
    base: str,
    checkpoint: str,
    salt: str,
    stream_id: str,
    available_now: bool = False,
    decode=decode_json,
    keys: DataFrame | None = None,
) -> StreamingQuery:
    """Stream messages of one table into the landing zone.

    Offsets are committed after a batch is published. A batch that is replayed after a failure is
    ``<stream_id>-<batch number>`` again: it is written anew if it had not been published and left alone if it
    had. Give each checkpoint its own ``stream_id``. No row is dropped as late.
    Batches follow one another as the source offers them (see ``kafka_options``); ``available_now``
    takes everything present and stops. ``keys`` holds tokens' keys per person (see ``landing_rows``).
    Run ``landing.close_hours`` from time to time, hourly for instance.
    """
    def write(messages_of_batch: DataFrame, number: int) -> None:
        ingest_batch(messages_of_batch, table, base, salt, decode, keys, f"{stream_id}-{number}")

    writer = (
        messages.writeStream.queryName(f"ingest-{table}-{stream_id}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_all(
    source: Callable[[str], DataFrame],
    base: str,
    checkpoint: str,
    salt: str,
    stream_id: str,
    tables: tuple[str, ...] = tuple(SOURCE_TABLES),
    **options,
) -> dict[str, StreamingQuery]:
    """One stream per table, each with its own checkpoint below ``checkpoint``.

    ``source`` gives the messages of a table's topic; ``options`` as for ``start_ingest``.
    """
    return {
        table: start_ingest(source(table), table, base, f"{checkpoint}/{table}", salt, stream_id, **options)
        for table in tables
    }


def dedup_stream(landing: DataFrame, delay: str) -> DataFrame:
    """Drop copies that arrive within ``delay`` of each other while still streaming.

    State is kept for ``delay`` only. Rows later than that are dropped by the watermark, so this
    is for live consumers; the landing job itself never uses it.
    """
    at = F.timestamp_millis(F.col("_cdc_ts_ms"))
    return (
        landing.withColumn("_event_time", at)
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(["_kafka_topic", "_kafka_partition", "_kafka_offset"])
        .drop("_event_time")
    )
