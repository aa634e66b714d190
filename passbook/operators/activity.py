"""Behaviour of an account around each completed transaction.

Per transaction: mean and deviation of the account's amounts, its count on the same day, its
average count per active day, and its transfers in the two hours up to and including this one.

Ordinary accounts: every feature is a window below one exchange on the account, and no join.
Heavy accounts (see ``skew``): amounts and days are partial aggregates joined back, where adaptive
skew join splits the fact side; the rolling count is a running sum over enter and leave marks, cut
into time slots. Both give the same rows; the split only decides where the work happens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passbook.contracts import MONEY
from passbook.functions.scalars import utc_micros
from passbook.operators.skew import (
    DEFAULT_POLICY,
    SLOT,
    Heavy,
    SkewPolicy,
    heavy_keys,
    slots_of,
    with_cuts,
)

FEATURES = [
    "acct_mean_amount",
    "acct_stddev_amount",
    "txns_on_same_day",
    "avg_daily_txns",
    "transfers_in_2h_window",
]


@dataclass(frozen=True)
class ActivityColumns:
    account: str = "from_account_id"
    time: str = "created_at"
    amount: str = "amount"
    kind: str = "transaction_type"
    rolling_kind: str = "TRANSFER"
    rolling_micros: int = 2 * 60 * 60 * 1_000_000


DEFAULT_COLUMNS = ActivityColumns()


def _mean(total: Column, n: Column) -> Column:
    """Exact decimal total divided as doubles, so the result does not depend on row order."""
    return total.cast("double") / n.cast("double")


def _square() -> Column:
    return F.col("_amount") * F.col("_amount")


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Population deviation from exact decimal sums: the same number however the rows were split.

    n * sum(x*x) - sum(x)**2 is exact in decimals up to 10**34; beyond, doubles stand in.
    """
    of = n.cast("decimal(13,0)")
    exact = F.try_subtract(F.try_multiply(of, squares), F.try_multiply(total, total)).cast("double")
    count, mean = n.cast("double"), total.cast("double")
    rough = count * squares.cast("double") - mean * mean
    return F.sqrt(F.greatest(F.coalesce(exact, rough), F.lit(0.0))) / F.nullif(count, F.lit(0.0))


def _daily(n: Column, days: Column) -> Column:
    return n.cast("double") / F.nullif(days, F.lit(0)).cast("double")


def _with_features(rows: DataFrame, originals: list[str], c: ActivityColumns) -> DataFrame:
    """Original columns followed by the features in their fixed order."""
    zero = F.lit(0).cast("bigint")
    return rows.select(
        *originals,
        F.col("_mean").alias("acct_mean_amount"),
        F.coalesce("_deviation", F.lit(0.0)).alias("acct_stddev_amount"),
        F.col("_same_day").cast("bigint").alias("txns_on_same_day"),
        # a missing account is counted like any other, but has no daily rate
        F.when(F.col(c.account).isNotNull(), F.col("_daily")).alias("avg_daily_txns"),
        F.when(F.col("_rolls"), F.coalesce("_rolling", zero))
        .otherwise(zero)
        .alias("transfers_in_2h_window"),
    )


def _ordinary(rows: DataFrame, c: ActivityColumns) -> DataFrame:
    account = Window.partitionBy(c.account)
    day = Window.partitionBy(c.account, "_day").orderBy("_micros")
    whole_day = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Events up to now minus events before the interval. Both frames only grow, so each row enters
    # its sum once; a frame with a moving start is summed anew for every row.
    in_time = Window.partitionBy(c.account, "_rolls").orderBy("_micros")
    until_now = in_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    too_old = in_time.rangeBetween(Window.unboundedPreceding, -(c.rolling_micros + 1))
    # One exchange on the account satisfies the three kinds of window below. No account here is heavy.
    per_day = rows.repartition(c.account).withColumns(
        {
            # same order as the row number, so that both share one sort
            "_same_day": F.count(F.lit(1)).over(whole_day),
            "_day_opens": (F.row_number().over(day) == 1) & F.col("_day").isNotNull(),
        }
    )
    n, days = F.count(F.lit(1)).over(account), F.count_if("_day_opens").over(account)
    total, valued = F.sum("_amount").over(account), F.count("_amount").over(account)
    return per_day.withColumns(
        {
            "_mean": _mean(total, valued),
            "_deviation": _deviation(valued, total, F.sum(_square()).over(account)),
            "_daily": _daily(n, days),
            "_rolling": F.count(F.lit(1)).over(until_now) - F.count(F.lit(1)).over(too_old),
        }
    )


def _rolling_by_marks(rows: DataFrame, heavy: Heavy, c: ActivityColumns) -> DataFrame:
    """(account, instant) → events in the rolling interval ending at that instant.

    Equal instants are counted before any shuffle. Each instant enters the running sum with +n and
    leaves it with −n just after the interval; the sum is taken inside a slot and completed by the
    total of the earlier slots. Its cost is linear, however many events share an interval.
    """
    entered = slots_of(rows.filter("_rolls"), heavy, c.account, F.col("_micros"), "_enters")
    slotted = slots_of(entered, heavy, c.account, F.col("_micros") + F.lit(c.rolling_micros + 1), "_leaves")
    instants = slotted.groupBy(c.account, "_micros", "_enters", "_leaves").agg(F.count(F.lit(1)).alias("_n"))
    enter = F.struct(F.col("_enters").alias(SLOT), F.col("_micros").alias("_at"), F.col("_n").alias("_step"))
    leave = F.struct(
        F.col("_leaves").alias(SLOT),
        (F.col("_micros") + F.lit(c.rolling_micros + 1)).alias("_at"),
        (-F.col("_n")).alias("_step"),
    )
    marks = instants.select(c.account, F.explode(F.array(enter, leave)).alias("_mark")).select(c.account, "_mark.*")
    before = (
        marks.groupBy(c.account, SLOT)
        .agg(F.sum("_step").alias("_net"))
        .select(
            F.col(c.account).alias("_before_key"),
            F.col(SLOT).alias("_before_slot"),
            F.sum("_net")
            .over(
                Window.partitionBy(c.account)
                .orderBy(SLOT)
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            .alias("_before"),
        )
    )
    in_slot = (
        Window.partitionBy(c.account, SLOT)
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matches = F.col(c.account).eqNullSafe(F.col("_before_key")) & F.col(SLOT).eqNullSafe(F.col("_before_slot"))
    return (
        marks.withColumn("_inside", F.sum("_step").over(in_slot))
        .filter("_step > 0")
        .join(before, matches, "left")
        .select(
            F.col(c.account).alias("_instant_key"),
            F.col("_at").alias("_instant"),
            (F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0))).alias("_rolling"),
        )
    )


def _per_day(rows: DataFrame, c: ActivityColumns) -> DataFrame:
    """(account, day) → count of the day and statistics of the account.

    Rows are aggregated per day before any shuffle; the account's statistics are then put together
    from its days, at most one row per calendar day.
    """
    account = Window.partitionBy("_day_key")
    days = rows.groupBy(F.col(c.account).alias("_day_key"), F.col("_day").alias("_day_of")).agg(
        F.count(F.lit(1)).alias("_same_day"),
        F.count("_amount").alias("_n"),
        F.sum("_amount").alias("_total"),
        F.sum(_square()).alias("_squares"),
    )
    n, total, squares = (F.sum(x).over(account) for x in ("_n", "_total", "_squares"))
    return days.withColumns(
        {
            "_mean": _mean(total, n),
            "_deviation": _deviation(n, total, squares),
            "_daily": _daily(F.sum("_same_day").over(account), F.count("_day_of").over(account)),
        }
    ).select("_day_key", "_day_of", "_same_day", "_mean", "_deviation", "_daily")


def _heavy(rows: DataFrame, heavy: Heavy, c: ActivityColumns) -> DataFrame:
    same_day = F.col(c.account).eqNullSafe(F.col("_day_key")) & F.col("_day").eqNullSafe(F.col("_day_of"))
    same_instant = F.col(c.account).eqNullSafe(F.col("_instant_key")) & F.col("_micros").eqNullSafe(
        F.col("_instant")
    )
    return rows.join(_per_day(rows, c), same_day, "left").join(
        _rolling_by_marks(rows, heavy, c), same_instant, "left"
    )


def with_activity(
    transactions: DataFrame,
    columns: ActivityColumns = DEFAULT_COLUMNS,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Completed transactions with the features of ``FEATURES`` appended.

    ``transactions`` is scanned once now, to find heavy accounts, once for ordinary accounts and,
    where heavy ones exist, again for them: pass a stored table, not a long lazy plan.
    """
    c = columns
    prepared = transactions.withColumns(
        {
            "_day": F.to_date(c.time),
            "_micros": utc_micros(F.col(c.time)),
            "_rolls": F.coalesce(F.col(c.kind) == c.rolling_kind, F.lit(False)),
            "_amount": F.col(c.amount).cast(MONEY),
        }
    )
    originals = transactions.columns
    heavy = heavy_keys(prepared, c.account, F.col("_micros"), policy)
    if heavy is None:
        return _with_features(_ordinary(prepared, c), originals, c)
    tagged = with_cuts(prepared, heavy, c.account)
    ordinary = _ordinary(tagged.filter(F.col("_cuts").isNull()), c)
    split = _heavy(tagged.filter(F.col("_cuts").isNotNull()), heavy, c)
    return _with_features(ordinary, originals, c).unionByName(_with_features(split, originals, c))


def completed(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("status") == "COMPLETED")


def rolling_count(
    transactions: DataFrame,
    columns: ActivityColumns = DEFAULT_COLUMNS,
    policy: SkewPolicy = DEFAULT_POLICY,
    name: str = "transfers_in_2h_window",
) -> DataFrame:
    """Only the rolling count, for the rows it applies to."""
    kinds = transactions.filter(F.col(columns.kind) == columns.rolling_kind)
    return with_activity(kinds, columns, policy).withColumnRenamed(
        "transfers_in_2h_window", name
    ).select(*transactions.columns, name)


def daily_rate(
    transactions: DataFrame, columns: ActivityColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Average number of rows per active day, by account.

    Counts per (account, day) first: the distinct count then needs no second copy of the rows.
    """
    c = columns
    days = transactions.groupBy(c.account, F.to_date(c.time).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return days.groupBy(c.account).agg(
        _daily(F.sum("_n"), F.count("_day")).alias("avg_daily_txns")
    )


def account_stats(
    transactions: DataFrame, columns: ActivityColumns = DEFAULT_COLUMNS
) -> DataFrame:
    """Mean and population deviation of the amounts, by account."""
    c = columns
    rows = transactions.withColumn("_amount", F.col(c.amount).cast(MONEY))
    n, total = F.count("_amount"), F.sum("_amount")
    return rows.groupBy(c.account).agg(
        _mean(total, n).alias("acct_mean_amount"),
        F.coalesce(_deviation(n, total, F.sum(_square())), F.lit(0.0)).alias("acct_stddev_amount"),
    )
