"""Calendar dimension: one row per day with its calendar parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.functions.expressions import days_in_month, is_month_end


def build_calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Days ``start..end`` inclusive.  Generated from one row with
    ``sequence``/``explode``, so no driver loop and no input table."""
    s, e = str(start), str(end)
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(s).cast("date"), F.lit(e).cast("date"))).alias("date_id")
    )
    d = F.col("date_id")
    return days.where(F.lit(s).cast("date") <= F.lit(e).cast("date")).select(
        d,
        F.year(d).alias("year_num"),
        F.month(d).alias("month_num"),
        F.dayofmonth(d).alias("day_num"),
        F.quarter(d).alias("quarter_num"),
        days_in_month(d).alias("days_in_month"),
        is_month_end(d).alias("is_month_end"),
    )


def calendar_profile(cal: DataFrame) -> DataFrame:
    """Period start/end, number of days and month-end flags."""
    return cal.agg(
        F.min("date_id").alias("period_start"),
        F.max("date_id").alias("period_end"),
        F.count(F.lit(1)).alias("total_days"),
        F.sum("is_month_end").cast("bigint").alias("month_end_flags"),
    )
