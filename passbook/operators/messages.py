"""Reduction of message logs: re-delivered copies, latest state, first event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

POSITION = ["_kafka_partition", "_kafka_offset"]


def drop_redelivered(log: DataFrame, position: list[str] | None = None) -> DataFrame:
    """Keep one row per log position.

    Copies of one message are equal, so any of them will do. The aggregate behind
    ``dropDuplicates`` removes copies before the shuffle as well as after it: a message delivered a
    billion times costs one row per map task. Add the topic to ``position`` if topics are mixed.
    """
    return log.dropDuplicates(position or POSITION)


def _one_per_key(log: DataFrame, keys: list[str], order: list) -> DataFrame:
    # row_number() <= 1 becomes a group limit that runs before the shuffle too
    window = Window.partitionBy(*keys).orderBy(*order)
    return log.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def latest_per_key(
    log: DataFrame,
    keys: list[str],
    time: str = "_cdc_ts_ms",
    drop_deleted: bool = False,
    op: str = "_cdc_op",
) -> DataFrame:
    """Last state per key; equal times are decided by log position.

    By default delete events are ignored, so a deleted key keeps its last state. With
    ``drop_deleted`` they take part and then remove the key. Re-delivered copies need no separate
    pass, because only one row per key is kept anyway.
    """
    if not drop_deleted:
        log = log.filter(F.col(op) != "d")
    order = [F.col(c).desc_nulls_last() for c in [time, *POSITION]]
    latest = _one_per_key(log, keys, order)
    return latest.filter(F.col(op) != "d") if drop_deleted else latest


def earliest_per_key(
    log: DataFrame,
    keys: list[str],
    time: str = "_cdc_ts_ms",
    ops: tuple[str, ...] = ("r", "c"),
    op: str = "_cdc_op",
) -> DataFrame:
    """First event per key among the given operations."""
    order = [F.col(c).asc_nulls_last() for c in [time, *POSITION]]
    return _one_per_key(log.filter(F.col(op).isin(*ops)), keys, order)
