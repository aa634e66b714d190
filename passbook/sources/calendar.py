"""Generated calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.functions.scalars import date_key


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, ``end`` excluded (ISO text or ``current_date()`` expressions)."""
    last = F.date_sub(F.expr(end), 1)
    return spark.range(1).select(F.explode(F.sequence(F.expr(start), last)).alias("date_day"))


def dim_date(spark: SparkSession, anchor: str | None = None) -> DataFrame:
    """Calendar from two years before the anchor day to three years after it, end excluded."""
    today = f"DATE'{anchor}'" if anchor else "current_date()"
    day = F.col("date_day")
    return days(spark, f"add_months({today}, -24)", f"add_months({today}, 36)").select(
        date_key(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.dayofweek(day) - 1).alias("day_of_week"),  # 0 = Sunday
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
