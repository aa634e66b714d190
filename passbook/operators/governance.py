"""Retention, erasure and keyed tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.contracts import RETENTION_DAYS
from passbook.functions.scalars import millis_to_utc, text_token
from passbook.sources.landing import close_hours, drop_hours, live_hours, vacuum

DAY_MILLIS = 24 * 60 * 60 * 1000


def retention_policy(spark: SparkSession, policy: dict[str, int] | None = None) -> DataFrame:
    rows = [(t, d, d * DAY_MILLIS) for t, d in sorted((policy or RETENTION_DAYS).items())]
    return spark.createDataFrame(rows, "dataset string, keep_days int, keep_ms bigint")


def oldest_kept(as_of: Column | str, days: int) -> Column:
    """First calendar day that is still kept; an event on exactly this day stays."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.date_sub(day, days)


def keep_within(rows: DataFrame, day: Column, as_of: Column | str, days: int) -> DataFrame:
    """Rows young enough for the policy. Running it again changes nothing."""
    return rows.filter(day >= oldest_kept(as_of, days))


def retention_report(
    rows: DataFrame, dataset: str, day: Column, as_of: Column | str, days: int
) -> DataFrame:
    """What the policy keeps and what it would expire."""
    kept = day >= oldest_kept(as_of, days)
    return rows.agg(
        F.count_if(kept).alias("rows_kept"),
        F.count_if(~kept).alias("rows_expired"),
        F.min(day).alias("oldest_day"),
    ).select(
        F.lit(dataset).alias("dataset"),
        F.lit(days).alias("keep_days"),
        "rows_kept",
        "rows_expired",
        "oldest_day",
    )


def _folder_day() -> Column:
    return F.to_date(F.concat("year", F.lit("-"), "month", F.lit("-"), "day"))


def expired_folders(
    spark: SparkSession, base: str, table: str, as_of: str, days: int | None = None
) -> DataFrame:
    """Days of a landing table that the policy expires, with their closed hours and rows.

    Works on the manifest alone; no file is listed or read. Open batches count once they are closed.
    """
    keep = RETENTION_DAYS[table] if days is None else days
    hours = live_hours(spark, base, table).filter(_folder_day() < oldest_kept(as_of, keep))
    return hours.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("hours"), F.sum("rows").alias("rows"))


def expire(
    spark: SparkSession, base: str, table: str, as_of: str, days: int | None = None, grace_ms: int = 0
) -> int:
    """Expire days that are older than the policy allows; returns how many.

    One change of the manifest hides all of them at once; then tasks delete their folders, and with them
    whatever else was replaced ``grace_ms`` ago or longer. A job that died in between is finished by the next one.
    """
    keep = RETENTION_DAYS[table] if days is None else days
    close_hours(spark, base, table)
    gone = drop_hours(spark, base, table, _folder_day() < oldest_kept(as_of, keep))
    expired = gone.select("year", "month", "day").distinct().count()
    vacuum(spark, base, table, grace_ms)
    return expired


def keyed_tokens(
    rows: DataFrame, keys: DataFrame, subject: str, columns: list[str], key: str = "token_key"
) -> DataFrame:
    """Tokens under a secret per subject instead of one shared salt.

    ``keys`` holds (subject, key). A subject without a key, such as one whose key was deleted on
    request, gets null tokens, and tokens made earlier can no longer be recomputed.
    """
    secrets = keys.select(F.col(subject).alias("_subject"), F.col(key).alias("_secret"))
    joined = rows.join(secrets, F.col(subject) == F.col("_subject"), "left")
    tokens = {c: text_token(F.col(c), F.col("_secret")) for c in columns}
    return joined.withColumns(tokens).select(*rows.columns)


def event_day(millis: Column) -> Column:
    return F.to_date(millis_to_utc(millis))
