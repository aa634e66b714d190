"""Sources of raw change messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, value string, timestamp timestamp"

# A micro-batch closes after sixty seconds or five thousand messages, whichever is first.
FLUSH_INTERVAL = "60s"
FLUSH_MESSAGES = 5000


def kafka_options(
    servers: str,
    topic: str,
    min_messages: int | None = FLUSH_MESSAGES,
    max_delay: str = FLUSH_INTERVAL,
    max_messages: int | None = None,
) -> dict[str, str]:
    """Reader options of one topic, from its earliest message.

    A batch starts as soon as ``min_messages`` wait or the oldest has waited ``max_delay``, and takes all
    that is there: a busy topic gets larger batches and is never held back. ``max_messages`` is a guard for
    clusters that cannot take a backlog in one batch; there is none by default.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if min_messages is not None:
        options |= {"minOffsetsPerTrigger": str(min_messages), "maxTriggerDelay": max_delay}
    if max_messages is not None:
        options["maxOffsetsPerTrigger"] = str(max_messages)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of one topic; ``options`` as in ``kafka_options``.

    One query per topic: each then has its own offsets, so no topic can commit another's unwritten
    messages. Needs Spark's Kafka module on the class path.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return reader.load().select("topic", "partition", "offset", "value", "timestamp")


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of message files (Parquet with the message columns); all new files make a batch."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
