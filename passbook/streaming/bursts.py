"""Burst flags on the stream: the two-hour transfer count of every completed transfer, with state in the checkpoint.

A transfer is judged once the watermark has passed it, when all transfers up to its instant are known, so
the flags are those of the batch rule. State is kept per account and pane of one window's length. A
transfer enters its own pane, where it is judged, and the next, where it is only counted; a pane
therefore holds two windows' transfers at most and is cleared by its last timer. A history that is
streamed again spreads a busy account over its panes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from passbook.functions.scalars import utc_micros
from passbook.operators.activity import DEFAULT_COLUMNS, ActivityColumns
from passbook.operators.rules import BURST_MIN_TRANSFERS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LISTED = 10_000  # instants that one value of the state holds
FLAGS = "transaction_id string, from_account_id string, created_micros bigint, transfers_in_2h_window bigint"


def _due(micros: int) -> int:
    """The first millisecond that no transfer up to ``micros`` can follow once the watermark is there."""
    return -(-micros // 1000)


class Bursts(StatefulProcessor):
    """State of one (account, pane): how many transfers an instant has, and which of them are not judged yet.

    Instants are kept in lists of up to ``LISTED``, not one by one: a call to the state store costs more than
    an instant, so a pane takes a few calls for each batch however many transfers it has.
    """

    def __init__(self, window: int, least: int):
        self.window, self.least = window, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lists = handle.getListState("lists", "micros array<bigint>, n array<bigint>, ids array<array<string>>")
        self.next = handle.getValueState("next", "due bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, tuple[int, list]] = {}
        for row in rows:
            n, ids = new.get(row.micros) or (0, [])
            if row.own:
                ids.append(row.transaction_id)
            new[row.micros] = (n + 1, ids)
        self._add([(micros, n, ids) for micros, (n, ids) in new.items()])
        known = self.next.get()
        first = min((_due(m) for m, (_, ids) in new.items() if ids), default=None)
        if known is None:
            self.handle.registerTimer(self._end(key))
        self._wake(self._end(key) if known is None else known[0], first, known is None)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.next.exists():
            return  # cleared by the pane's end
        now = timerValues.getCurrentWatermarkInMs()
        found = self._instants()
        first = inside = 0
        waiting = None
        for at, (micros, n, ids) in enumerate(found):
            inside += n
            while found[first][0] < micros - self.window:
                inside -= found[first][1]
                first += 1
            if not ids:
                continue
            if _due(micros) > now:
                waiting = _due(micros)
                break
            if inside >= self.least:
                for transaction in ids:
                    yield Row(
                        transaction_id=transaction, from_account_id=key[0], created_micros=micros, transfers_in_2h_window=inside
                    )
            found[at] = (micros, n, [])
        self.lists.clear()
        if now >= self._end(key):
            self.next.clear()
            return
        self._add(found)
        self._wake(self._end(key), waiting, True)

    def _add(self, instants: list[tuple[int, int, list]]) -> None:
        for at in range(0, len(instants), LISTED):
            self.lists.appendValue(tuple(map(list, zip(*instants[at : at + LISTED], strict=True))))

    def _instants(self) -> list[tuple[int, int, list]]:
        """All instants in order, those of several lists put together."""
        found: dict[int, tuple[int, list]] = {}
        for each in self.lists.get():
            for micros, n, ids in zip(*each, strict=True):
                before, earlier = found.get(micros) or (0, [])
                found[micros] = (before + n, [*earlier, *ids])
        return [(micros, *found[micros]) for micros in sorted(found)]

    def _end(self, key) -> int:
        return _due((key[1] + 1) * self.window)

    def _wake(self, known: int, due: int | None, changed: bool) -> None:
        """Keep the next timer: ``known``, which the state may not hold yet (``changed``), or ``due`` if it is earlier."""
        if due is not None and due < known:
            self.handle.registerTimer(due)
            known, changed = due, True
        if changed:
            self.next.update((known,))

    def close(self) -> None:
        pass


def burst_flags(facts: DataFrame, delay: str, columns: ActivityColumns = DEFAULT_COLUMNS, least: int = BURST_MIN_TRANSFERS) -> DataFrame:
    """``transaction_id, from_account_id, created_micros, transfers_in_2h_window`` of the flagged transfers of a stream.

    Facts may come in any order within ``delay``; later ones are dropped by the watermark. A missing account
    is counted like any other, facts without time are left out. Each row counts, so remove redelivered
    messages before. The last ``delay`` of a stream waits for the facts that follow.
    """
    c = columns
    micros = utc_micros(F.col(c.time))
    transfers = facts.filter((F.col(c.kind) == c.rolling_kind) & (F.col("status") == "COMPLETED") & F.col(c.time).isNotNull())
    timed = transfers.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col(c.account).cast("string").alias("account"),
        micros.alias("micros"),
        F.timestamp_micros(micros).alias("at"),
    ).withWatermark("at", delay)
    pane = F.floor(F.col("micros") / F.lit(c.rolling_micros)).cast("bigint")
    both = timed.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    both = both.withColumn("pane", F.when(F.col("own"), pane).otherwise(pane + 1))
    return both.groupBy("account", "pane").transformWithState(
        Bursts(c.rolling_micros, least), FLAGS, outputMode="append", timeMode="EventTime"
    )


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; others are left as they are."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start_flags(
    facts: DataFrame, path: str, checkpoint: str, delay: str, available_now: bool = False, **options
) -> StreamingQuery:
    """Append the flags of a stream of facts to a Parquet table (``options`` as for ``burst_flags``).

    State, timers and watermark are in ``checkpoint``: a job that is started again goes on where the last one ended.
    """
    writer = (
        burst_flags(facts, delay, **options)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    with _rocksdb(facts.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
