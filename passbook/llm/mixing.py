"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a keyed shuffled order. A document's virtual finish time is
the number of its source's words up to and including it, divided by the source's target; a pass over
the source that is repeated starts where the last one ended. The mix is what is served up to the
budget, in order of virtual finish time. The targets add up to the budget, so all queues reach their
target at virtual time 1: cutting the globally sorted queue at the budget and cutting it at virtual
time 1 are the same cut, and no global running total is needed.

Only DataFrame functions are used. The running total of a source is made in two steps (inside buckets
of bounded size, then over bucket totals), so a source with most of the rows is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.columns import WORD, quoted, spare
from passbook.workspace import stored

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BUCKET_ROWS = 4096


def n_words(text: Column) -> Column:
    """Words of a text as long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Shuffle key: 32 hex digits, the same for a row whatever the partitions are."""
    blank = F.lit("")
    return F.md5(
        F.concat_ws(
            "|",
            F.lit(str(seed)),
            F.coalesce(doc_id.cast("string"), blank),
            F.md5(F.coalesce(text, blank).cast("binary")),
        ).cast("binary")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources by code point, null last, get ``weights`` in turn. The total of all sizes is shared by
    weight; a target stops at ``passes`` times its source's size and the excess goes to the others by
    weight. That is the water level L with sum(min(passes * size, L * weight)) = total: sources are
    ordered by the level at which they stop, and those that stop below the level the rest would get
    are full. The windows run over one row per source, a list that a mix's configuration bounds.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = per_source.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(turn, F.lit(len(weights))) + 1))
    listed = listed.withColumn("_stop", F.col("source_size") * passes)
    by_level = Window.orderBy(F.col("_stop").cast("double") / F.col("_weight"), F.col("source").asc_nulls_last())
    above = by_level.rowsBetween(0, Window.unboundedFollowing)
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # what a source and all that stop later would share, had all the earlier ones stopped
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("_stop").over(below), F.lit(0))
    tried = listed.withColumn("_left", left).withColumn("_heavier", F.sum("_weight").over(above))
    full = F.col("_stop").cast("double") * F.col("_heavier") <= F.col("_left").cast("double") * F.col("_weight")
    tried = tried.withColumn("_full", full)
    opened = F.struct((F.col("_stop").cast("double") / F.col("_weight")).alias("level"), F.col("_left"), F.col("_heavier"))
    first_open = F.min(F.when(~F.col("_full"), opened)).over(everywhere)
    share = F.col("_weight") * first_open["_left"].cast("double") / first_open["_heavier"]
    target = F.when(F.col("_full"), F.col("_stop").cast("double")).otherwise(share)
    return tried.select("source", "source_size", target.alias("target"))


def queue(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    passes: int = MAX_PASSES,
    seed: int = 7,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The queues: one row per group of rows that agree in id, source and text.

    Columns ``doc_id, source, key, size`` (words of one row), ``copies`` (rows of the group),
    ``before`` (words of the source's rows ahead of it in a pass), ``source_size, target``.
    Identical rows are counted before anything is shuffled by source.
    """
    rows = docs.select(
        quoted(id_column).alias("doc_id"),
        quoted(source_column).alias("source"),
        n_words(quoted(text_column)).alias("size"),
        order_key(quoted(id_column), quoted(text_column), seed).alias("key"),
    )
    groups = stored(rows.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("copies")), "mixing")
    weighed = groups.withColumn("_words", F.col("size") * F.col("copies"))
    per_source = weighed.groupBy("source").agg(
        F.sum("_words").alias("size"), F.ceil(F.count("*") / F.lit(bucket_rows)).alias("_buckets")
    )
    targets = source_targets(per_source, weights, passes)
    numbered = per_source.select(F.col("source").alias("_source"), "_buckets").join(
        targets.withColumnRenamed("source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))
    )
    placed = weighed.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        # the key's leading 32 bits place a row in equal parts of its source, in key order
        "_bucket",
        F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * F.col("_buckets")),
    )
    # dealt by both: rows that the join has dealt by source would otherwise stay together
    placed = placed.repartition("source", "_bucket")
    ahead = Window.partitionBy("source", "_bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("source", "_bucket").agg(F.sum("_words").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("_o_source"),
        F.col("_bucket").alias("_o_bucket"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = placed.withColumn("_inside", F.coalesce(F.sum("_words").over(ahead), F.lit(0)))
    return inside.join(
        offsets, F.col("source").eqNullSafe(F.col("_o_source")) & (F.col("_bucket") == F.col("_o_bucket"))
    ).select(
        "doc_id", "source", "key", "size", "copies", (F.col("_offset") + F.col("_inside")).alias("before"), "source_size", "target"
    )


def virtual_time(words: Column, target: Column) -> Column:
    """When a source has served so many words; 1 is the time at which every source reaches its target."""
    return words / F.when(target > 0, target).otherwise(F.lit(1.0))


def finish_time(start: Column, size: Column, target: Column) -> Column:
    """Virtual finish time of a row that starts ``start`` words into its queue."""
    return virtual_time(start + size, target)


def _ranges(queues: DataFrame, rows: int) -> DataFrame:
    """The groups with one row per copy (``_copy`` from 0); a group of many copies is dealt to several tasks."""
    few = queues.filter(F.col("copies") <= rows).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    )
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(rows).cast("long"))).alias("_range")
    many = queues.filter(F.col("copies") > rows).select("*", start).repartition("key", "_range")
    last = F.least(F.col("_range") + rows, F.col("copies")) - 1
    return few.unionByName(many.withColumn("_copy", F.explode(F.sequence("_range", last))).drop("_range"))


def taken_words(queues: DataFrame, passes: int = MAX_PASSES, range_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row, copies apart.

    A row whose virtual finish time in a pass is at most 1 is served whole. The one that is being served
    at virtual time 1, where the sorted queue reaches the budget, gives as many words as its target still lacks.
    """
    size, target = F.col("size"), F.col("target")

    def in_pass(number: int) -> Column:
        start = F.col("before") + F.col("_copy") * size + F.col("source_size") * number
        partly = F.greatest(F.lit(0).cast("long"), F.floor(target).cast("long") - start)
        served = F.when(finish_time(start, size, target) <= 1, size).when(virtual_time(start, target) < 1, F.least(size, partly))
        return served.otherwise(0)

    taken = sum((in_pass(k) for k in range(1, passes)), in_pass(0))
    taken = F.when(target > 0, taken).otherwise(0)
    return _ranges(queues, range_rows).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _finishes(own: dict[str, str], turn: Column, passes: int) -> Column:
    """Finish times of the passes in which row ``turn`` (from 0) of a group is in the mix, as a whole.

    It is in a pass if at least half of its words are served by virtual time 1; blank rows (no word)
    are in the first pass. ``own``: how the columns of ``queue`` are called here.
    """
    size, target = F.col(own["size"]), F.col(own["target"])

    def in_pass(number: int) -> Column:
        start = F.col(own["before"]) + turn * size + F.col(own["source_size"]) * number
        half = (size > 0) & (start + size / 2 <= target)
        blank = (size == 0) & F.lit(number == 0)
        return F.when(half | blank, finish_time(start, size, target))

    return F.array_compact(F.array(*(in_pass(k) for k in range(passes))))


def _with_turns(rows: DataFrame, group: list[str], part: str, turn: str) -> DataFrame:
    """Number the rows of each group from 0, no group ever meeting in one task.

    ``part`` is the scan task that a row came from. Rows are numbered within group and part, and each part starts
    where the parts before it end. The rows are stored, so that both steps see the same parts.
    """
    rows = stored(rows, "identical_rows")
    name = [F.col(c) for c in group]
    within = Window.partitionBy(*name, part).orderBy(F.lit(0))
    sizes = rows.groupBy(*(n.alias(f"_{k}") for k, n in enumerate(name)), F.col(part).alias("_part")).agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_0", "_1", "_2").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    matches = reduce(lambda a, b: a & b, (n.eqNullSafe(F.col(f"_{k}")) for k, n in enumerate(name)), F.col(part) == F.col("_part"))
    numbered = rows.withColumn(turn, F.row_number().over(within) - 1).join(starts, matches)
    return numbered.withColumn(turn, (F.col(turn) + F.col("_first")).cast("long")).drop("_0", "_1", "_2", "_part", "_first")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    passes: int = MAX_PASSES,
    seed: int = 7,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The mixed documents with all columns of ``docs``, sorted by virtual finish time.

    A document that the mix takes k times comes k times; only whole documents come. Null texts and
    blank texts have no words and come once, null ids and sources are values like others, and of
    identical rows each is served in its turn. An empty table gives an empty table. Columns of
    ``docs`` may have any names.
    """
    queues = queue(docs, id_column, text_column, source_column, weights, passes, seed, bucket_rows)
    key, finish, part, turn, *names = spare(
        docs, "mix_order", "mix_finish", "mix_part", "mix_turn", *(f"mix_{c}" for c in queues.columns)
    )
    own = dict(zip(queues.columns, names, strict=True))
    keyed = docs.withColumn(key, order_key(quoted(id_column), quoted(text_column), seed)).withColumn(part, F.spark_partition_id())
    matches = (
        (F.col(key) == F.col(own["key"]))
        & quoted(id_column).eqNullSafe(F.col(own["doc_id"]))
        & quoted(source_column).eqNullSafe(F.col(own["source"]))
    )
    joined = keyed.join(queues.select(*(F.col(c).alias(name) for c, name in own.items())), matches)
    served = joined.filter(F.col(own["copies"]) == 1).withColumn(turn, F.lit(0).cast("long"))
    # identical rows share out their group's times: row r has the r-th time of each pass
    if not queues.filter("copies > 1").isEmpty():
        group = [own["key"], own["doc_id"], own["source"]]
        served = served.unionByName(_with_turns(joined.filter(F.col(own["copies"]) > 1), group, part, turn))
    served = served.withColumn(finish, F.explode(_finishes(own, F.col(turn), passes)))
    ordered = served.repartitionByRange(F.col(finish), F.col(key)).sortWithinPartitions(finish, key)
    return ordered.select(*map(quoted, docs.columns))
