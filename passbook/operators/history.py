"""State history of a keyed change log: change points, version intervals, as-of lookup.

All three walk the events of a key in time order. Heavy keys are cut into time slots (see
``skew``); the state that crosses a slot border travels in a table with one row per slot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passbook.functions.scalars import md5_key, millis_to_utc, utc_micros
from passbook.operators.messages import POSITION
from passbook.operators.skew import DEFAULT_POLICY, SLOT, SkewPolicy, placed, with_slot

TRACKED = ("balance", "status")


def _is_change(tracked: tuple[str, ...]) -> Column:
    """First event, or a tracked value moved.

    The leading column decides what counts as first event: a null previous value does. A later
    column treats a null previous value as empty text.
    """
    lead, *rest = tracked
    moved = [F.col(lead) != F.col(f"_prev_{lead}")]
    moved += [
        F.col(c).cast("string") != F.coalesce(F.col(f"_prev_{c}").cast("string"), F.lit(""))
        for c in rest
    ]
    any_moved = reduce(lambda a, b: a | b, [F.coalesce(m, F.lit(False)) for m in moved])
    return F.col(f"_prev_{lead}").isNull() | any_moved


def change_points(
    log: DataFrame,
    key: str = "account_id",
    time: str = "_cdc_ts_ms",
    tracked: tuple[str, ...] = TRACKED,
    policy: SkewPolicy = DEFAULT_POLICY,
    keep_slot: bool = False,
) -> DataFrame:
    """Events that changed a tracked column, compared with the previous event of the key.

    Re-delivered copies of a message stand next to each other in this order and agree in every column, so a
    row whose predecessor has its log position is dropped here and needs no exchange of its own.
    Uses the slots of ``log`` if it carries them; ``keep_slot`` hands them on.
    """
    order = [time, *POSITION]
    along = placed(F.col(time), *[F.col(c) for c in POSITION])
    slotted = log if SLOT in log.columns else with_slot(log, key, along, policy)

    # last state of every slot, offered to the next slot of the same key
    slot_end = (
        slotted.filter(F.col(SLOT).isNotNull())
        .groupBy(key, SLOT)
        .agg(F.max_by(F.struct(*tracked), F.struct(*order)).alias("_end"))
        .select(
            F.col(key).alias("_carry_key"),
            F.col(SLOT).alias("_carry_slot"),
            F.lag("_end").over(Window.partitionBy(key).orderBy(SLOT)).alias("_carry"),
        )
    )

    in_slot = Window.partitionBy(key, SLOT).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    walked = slotted.select(
        "*",
        F.row_number().over(in_slot).alias("_nth"),
        *[F.lag(c).over(in_slot).alias(f"_lag_{c}") for c in [*tracked, *POSITION]],
    )
    copies = (F.col("_nth") > 1) & reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_lag_{c}")) for c in POSITION]
    )
    walked = walked.filter(~copies)
    matches = (F.col(key) == F.col("_carry_key")) & (F.col(SLOT) == F.col("_carry_slot"))
    with_previous = walked.join(slot_end, matches, "left").withColumns(
        {
            f"_prev_{c}": F.when(F.col("_nth") == 1, F.col(f"_carry.{c}")).otherwise(
                F.col(f"_lag_{c}")
            )
            for c in tracked
        }
    )
    columns = [c for c in log.columns if c != SLOT] + ([SLOT] if keep_slot else [])
    return with_previous.filter(_is_change(tracked)).select(*columns)


def version_intervals(
    changes: DataFrame,
    key: str = "account_id",
    time: str = "change_ts_ms",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Type 2 history: each change opens a version that the next change of the key closes.

    Adds ``account_sk``, ``valid_from``, ``valid_to`` (null while open), ``is_current`` and
    ``version_number``. Uses the slots of ``changes`` if it carries them.
    """
    slotted = changes if SLOT in changes.columns else with_slot(changes, key, F.col(time), policy)
    ties = [c for c in POSITION if c in changes.columns]

    by_slot = Window.partitionBy(key).orderBy(SLOT)
    slots = (
        slotted.filter(F.col(SLOT).isNotNull())
        .groupBy(key, SLOT)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_first"))
        .select(
            F.col(key).alias("_carry_key"),
            F.col(SLOT).alias("_carry_slot"),
            F.sum("_n")
            .over(by_slot.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_versions_before"),
            F.lead("_first").over(by_slot).alias("_next_slot_start"),
        )
    )

    in_slot = Window.partitionBy(key, SLOT).orderBy(
        *[F.col(c).asc_nulls_last() for c in [time, *ties]]
    )
    numbered = slotted.select(
        "*",
        F.lead(time).over(in_slot).alias("_next_in_slot"),
        F.row_number().over(in_slot).alias("_nth"),
    )
    matches = (F.col(key) == F.col("_carry_key")) & (F.col(SLOT) == F.col("_carry_slot"))
    closes_at = F.coalesce(F.col("_next_in_slot"), F.col("_next_slot_start"))
    payload = [c for c in changes.columns if c not in (SLOT, time, *POSITION)]
    return numbered.join(slots, matches, "left").select(
        md5_key(F.col(key), F.col(time)).alias("account_sk"),
        *payload,
        millis_to_utc(F.col(time)).alias("valid_from"),
        millis_to_utc(closes_at).alias("valid_to"),
        closes_at.isNull().alias("is_current"),
        (F.col("_nth") + F.coalesce(F.col("_versions_before"), F.lit(0))).alias("version_number"),
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_time: str,
    take: list[str],
    version_key: str = "account_id",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add to each fact the columns ``take`` of the version valid at its time.

    A version holds for ``valid_from <= t < valid_to``. Facts and versions are merged into one
    time line per key and each fact takes the last version before it, so the cost is one sort; an
    equality-plus-range join would pair every fact of a key with every version of it.
    Facts without a valid version keep nulls; those without a key or a time go round the time line.
    """
    known = F.col(fact_key).isNotNull() & F.col(fact_time).isNotNull()
    keyless, facts = facts.filter(~known), facts.filter(known)
    version = F.struct(F.col("valid_to").alias("_until"), *take)
    line = versions.filter(F.col(version_key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(version_key).alias("_line_key"),
        F.col("valid_from").alias("_at"),
        F.col("version_number").cast("bigint").alias("_seq"),
        version.alias("_version"),
    ).unionByName(
        facts.select(
            F.col(fact_key).alias("_line_key"),
            F.col(fact_time).alias("_at"),
            F.lit(2**62).alias("_seq"),  # after every version that starts at the same instant
            *facts.columns,
        ),
        allowMissingColumns=True,
    )
    micros = utc_micros(F.col("_at"))
    slotted = with_slot(line, "_line_key", micros, policy)

    is_version = F.col("_version").isNotNull()
    by_slot = Window.partitionBy("_line_key").orderBy(SLOT)
    slot_end = (
        slotted.filter(F.col(SLOT).isNotNull())
        .groupBy("_line_key", SLOT)
        .agg(F.max_by("_version", F.when(is_version, F.struct("_at", "_seq"))).alias("_end"))
        .select(
            F.col("_line_key").alias("_carry_key"),
            F.col(SLOT).alias("_carry_slot"),
            F.last("_end", ignorenulls=True)
            .over(by_slot.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_carry"),
        )
    )
    in_slot = (
        Window.partitionBy("_line_key", SLOT)
        .orderBy("_at", "_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matches = (F.col("_line_key") == F.col("_carry_key")) & (
        F.col(SLOT) == F.col("_carry_slot")
    )
    seen = F.coalesce(F.col("_last"), F.col("_carry"))
    holds = F.col("_seen._until").isNull() | (F.col("_at") < F.col("_seen._until"))
    found = (
        slotted.withColumn("_last", F.last("_version", ignorenulls=True).over(in_slot))
        .filter(~is_version)
        .join(slot_end, matches, "left")
        .withColumn("_seen", seen)
        .select(*facts.columns, *[F.when(holds, F.col(f"_seen.{c}")).alias(c) for c in take])
    )
    return found.unionByName(keyless, allowMissingColumns=True)
