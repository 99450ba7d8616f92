"""The fiscal calendar and joins to it.

A calendar has one row per date. The generated one has a known size, so Spark broadcasts it by itself;
a calendar read from a table is broadcast when its measured size allows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.functions import dates

MAX_DAYS = 200_000


def fiscal_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """cal_dt, fscl_wk_nbr, fscl_yr_wk_key, wk_begin, prev_wk_begin for every date in the range."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if not 0 < days <= MAX_DAYS:
        raise ValueError(f"a calendar of {days} days is not plausible")
    cal_dt = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    rows = spark.range(0, days, numPartitions=1).select(cal_dt.alias("cal_dt"))
    begin = F.date_trunc("week", F.col("cal_dt")).cast("date")
    return rows.select(
        "cal_dt",
        dates.fiscal_week(F.col("cal_dt")).cast("int").alias("fscl_wk_nbr"),
        dates.fiscal_week_key(F.col("cal_dt")).alias("fscl_yr_wk_key"),
        begin.alias("wk_begin"),
        F.date_sub(begin, 7).alias("prev_wk_begin"),
    )


def calendar_join(df: DataFrame, cal: DataFrame, date_col: str, prefix: str, how: str = "left") -> DataFrame:
    """Attach week number and week key of ``date_col`` as ``<prefix>_wk_nbr`` and ``<prefix>_wk_key``."""
    side = cal.select(
        F.col("cal_dt").alias("_cal_dt"),
        F.col("fscl_wk_nbr").alias(f"{prefix}_wk_nbr"),
        F.col("fscl_yr_wk_key").alias(f"{prefix}_wk_key"),
    )
    return df.join(side, F.col(date_col) == F.col("_cal_dt"), how).drop("_cal_dt")


def previous_week(cal: DataFrame, as_of: str) -> DataFrame:
    """The calendar rows of the week before the week of ``as_of`` (seven rows)."""
    today = cal.where(F.col("cal_dt") == F.lit(as_of).cast("date"))
    begin = today.select(F.col("prev_wk_begin").alias("wk_begin"))
    return cal.join(begin, "wk_begin", "left_semi")


def prev_week_join(df: DataFrame, cal: DataFrame, date_col: str, as_of: str) -> DataFrame:
    """Rows whose date falls in the week before ``as_of``, with their week key."""
    days = previous_week(cal, as_of).select(F.col("cal_dt").alias("_cal_dt"), "fscl_yr_wk_key")
    return df.join(days, F.col(date_col) == F.col("_cal_dt")).drop("_cal_dt")
