"""Splitting of heavy keys, so that no window or sort ever holds one of them whole.

Joins and aggregates cope with a heavy key on their own (adaptive skew join, partial
aggregation). Windows do not: every row of a key meets in one task. The jobs here therefore

1. find the heavy keys (``heavy_keys``): one pruned scan with partial counts. With n rows there are no more
   than n / ``min_rows`` of them; the list is a stored table, never collected;
2. cut each heavy key into consecutive slots along the ordering column (``with_slot``) at quantiles of its
   own rows, so that slots hold equally many rows however uneven the times are. Rows of one
   instant are never parted. A key of more than ``CUTS`` slots is cut again within its slots, and so on,
   so that no slot grows with its key;
3. run the window per (key, slot) and hand the state at the end of a slot to the next one through
   a table with one row per slot.

Keys that are not heavy have no slot (null) and need no hand-over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.workspace import stored

SLOT = "_slot"
#: Slots that one level of quantiles gives a heavy key; a larger one is cut in several levels.
CUTS = 1000
#: Rows without order value come after all that have one, by their place.
AFTER_ALL = 2**61
#: A list of so many keys, 8 kB each at most, is sent to the tasks; a longer one is joined.
SENT_KEYS = 4000


@dataclass(frozen=True)
class SkewPolicy:
    min_rows: int = 1_000_000  # one task sorts a key below this without a second thought
    slot_rows: int = 1_000_000  # aimed-at rows per slot of a heavy key


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class Heavy:
    """Heavy keys: ``cuts`` has ``_key, _cuts``; each table of ``finer`` cuts single slots (``_key, _part, _fine``)."""

    cuts: DataFrame
    finer: tuple[DataFrame, ...] = ()


def placed(order: Column, *place: Column) -> Column:
    """``order`` for slots, with rows that have none after all others in order of partition and offset.

    Slots only need an order that never falls: places beyond 2**17 partitions or 2**43 offsets share one.
    """
    partition, offset = (
        F.least(F.coalesce(p.cast("bigint"), F.lit(top)), F.lit(top)) for p, top in zip(place, (2**17 - 1, 2**43 - 1), strict=True)
    )
    timed = F.least(order.cast("bigint"), F.lit(AFTER_ALL - 1))
    return F.when(order.isNotNull(), timed).otherwise(F.lit(AFTER_ALL) + partition * 2**43 + offset)


def _quantiles(order: Column) -> Column:
    return F.percentile_approx(order, [k / CUTS for k in range(1, CUTS)], 20 * CUTS)


def _chosen(n: Column, quantiles: Column, slot_rows: int) -> Column:
    """Cut points for slots of about ``slot_rows`` rows, CUTS - 1 at most."""
    slots = F.least(F.ceil(n / slot_rows), F.lit(CUTS)).cast("int")
    points = F.transform(
        F.sequence(F.lit(1), slots - 1),
        lambda k: F.element_at(quantiles, F.round(k * (F.lit(1.0) * CUTS / slots)).cast("int")).cast("bigint"),
    )
    none = F.array().cast("array<bigint>")
    return F.when((slots > 1) & quantiles.isNotNull(), F.array_distinct(points)).otherwise(none)


def heavy_keys(
    df: DataFrame, key: str, order: Column, policy: SkewPolicy, with_null: bool = True
) -> Heavy | None:
    """The heavy keys with the cut points of their slots, or None.

    Runs one job now, and one over the heavy keys' rows for each level of cuts if there are any: one level up to
    CUTS * slot_rows rows, two up to CUTS times as many. The tables are stored: every branch of a plan splits
    by the same keys, even if a lost executor makes Spark compute a branch again, and a table without heavy
    keys gets a plan without any splitting.
    """
    keyed = df if with_null else df.filter(F.col(key).isNotNull())
    counts = keyed.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = stored(counts.filter(F.col("_n") >= policy.min_rows), "heavy_keys")
    most = heavy.agg(F.max("_n")).first()[0]
    if most is None:
        return None
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    spread = df.join(heavy, same_key).groupBy("_key").agg(_quantiles(order).alias("_all"), F.first("_n").alias("_n"))
    # rows without order value are never in a slot with others
    cuts = F.array_sort(F.array_distinct(F.concat(_chosen(F.col("_n"), F.col("_all"), policy.slot_rows), F.array(F.lit(AFTER_ALL)))))
    found = Heavy(stored(spread.select("_key", cuts.alias("_cuts")), "slot_cuts"))
    reach = policy.slot_rows * CUTS
    while reach < most:
        # only keys that the levels so far leave too large
        large = keyed.join(heavy.filter(F.col("_n") > reach), same_key).drop("_key", "_n")
        part = slots_of(with_cuts(large, found, key), found, key, order, "_part")
        cells = part.groupBy(F.col(key).alias("_key"), "_part").agg(F.count(F.lit(1)).alias("_n"), _quantiles(order).alias("_all"))
        fine = _chosen(F.col("_n"), F.col("_all"), policy.slot_rows)
        cells = cells.filter(F.col("_n") > policy.slot_rows).select("_key", "_part", fine.alias("_fine"))
        found = Heavy(found.cuts, (*found.finer, stored(cells, "finer_cuts")))
        reach *= CUTS
    return found


def with_cuts(df: DataFrame, heavy: Heavy, key: str) -> DataFrame:
    """Add ``_cuts`` of the row's key; null for ordinary keys."""
    small = heavy.cuts.count() <= SENT_KEYS
    cuts = F.broadcast(heavy.cuts) if small else heavy.cuts
    return df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def slots_of(df: DataFrame, heavy: Heavy, key: str, order: Column, name: str = SLOT) -> DataFrame:
    """Add the slot of every row of a frame ``with_cuts``: increasing with ``order``, null for ordinary keys."""
    slotted = df.withColumn(name, slot_number(order))
    for level in heavy.finer:
        small = level.count() <= SENT_KEYS
        inner = level.withColumnRenamed("_part", "_of")
        matches = F.col(key).eqNullSafe(F.col("_key")) & (F.col(name) == F.col("_of"))
        slotted = slotted.join(F.broadcast(inner) if small else inner, matches, "left").drop("_key", "_of")
        # as many numbers to every slot, used or not, so that the order stays; 2**62 is that of rows without order
        deeper = F.col(name) * CUTS + F.coalesce(_passed("_fine", order), F.lit(0))
        slotted = slotted.withColumn(name, F.when(order.isNull(), F.col(name)).otherwise(deeper)).drop("_fine")
    return slotted


def _passed(cuts: str, order: Column) -> Column:
    """The number of cut points up to the value, found by halving; null without cut points."""
    steps = F.sequence(F.lit(1), F.lit((CUTS + 1).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        passed = F.get(cuts, middle) <= order
        open_ = s["low"] < s["high"]
        return F.struct(
            F.when(open_ & passed, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(open_ & ~passed, middle).otherwise(s["high"]).alias("high"),
        )

    return F.when(F.col(cuts).isNotNull(), F.aggregate(steps, start, halve)["low"].cast("bigint"))


def slot_number(order: Column) -> Column:
    """Slots of the first level, increasing with ``order`` (null order last); null for ordinary keys."""
    number = F.when(order.isNotNull(), _passed("_cuts", order)).otherwise(F.lit(2**62))
    return F.when(F.col("_cuts").isNotNull(), number)


def with_slot(df: DataFrame, key: str, order: Column, policy: SkewPolicy) -> DataFrame:
    """Find the heavy keys of ``df`` (a job) and add the slot column.

    Without heavy keys the slot is a null constant: the optimizer then removes all hand-over. A null key gets
    no slot, so that slots can be joined by plain equality, which keeps the rows where they are.
    """
    heavy = heavy_keys(df, key, order, policy, with_null=False)
    if heavy is None:
        return df.withColumn(SLOT, F.lit(None).cast("bigint"))
    slotted = slots_of(with_cuts(df, heavy, key), heavy, key, order).drop("_cuts")
    # dealt by both: after a join that dealt rows by key alone, all slots of a key would stay together
    return slotted.repartition(key, SLOT)
