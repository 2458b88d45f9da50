"""Safe casts, hour and day ranges."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.text import HOUR_FOLDER_FORMAT

ZONE = "Asia/Kolkata"


def safe_cast(column: Column | str, data_type: str) -> Column:
    """Cast that gives a missing value instead of an error."""
    col = F.col(column) if isinstance(column, str) else column
    return col.try_cast(data_type)


def hours_between(start: Column, end: Column) -> Column:
    """Array of hours after ``start`` up to ``end``; empty when there are none."""
    hour = F.expr("INTERVAL 1 HOUR")
    first = start + hour
    return F.when(first <= end, F.sequence(first, end, hour)).otherwise(F.array().cast("array<timestamp_ntz>"))


def hour_folder(hour: Column) -> Column:
    """``y=2024/m=01/d=31/h=07/m=00``."""
    return F.date_format(hour, HOUR_FOLDER_FORMAT)


def days_between(start: Column, end: Column) -> Column:
    """Array of days from ``start`` to the day before ``end``."""
    last = F.date_sub(end, 1)
    return F.when(start <= last, F.sequence(start, last, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )


def hourly_suffixes(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Hour folders to read: after ``start``, up to and including ``end``."""
    if not start < end:
        raise ValueError(f"start {start} is not before end {end}")
    span = spark.range(1).select(
        F.lit(start.replace(tzinfo=None)).cast("timestamp_ntz").alias("a"),
        F.lit(end.replace(tzinfo=None)).cast("timestamp_ntz").alias("b"),
    )
    return span.select(F.explode(hours_between(F.col("a"), F.col("b"))).alias("hour")).select(
        hour_folder(F.col("hour")).alias("suffix")
    )


def date_window(
    mode: str, start: dt.date | None = None, end: dt.date | None = None, zone: str = ZONE
) -> tuple[dt.date, dt.date]:
    """First and last day (both included) of a run: yesterday, or start..end-1."""
    if mode.lower() == "yesterday":
        day = dt.datetime.now(ZoneInfo(zone)).date() - dt.timedelta(days=1)
        return day, day
    if start is None or end is None:
        raise ValueError("start and end are needed unless mode is 'yesterday'")
    return start, end - dt.timedelta(days=1)


def in_date_range(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the days first..last; prunes partitions on a date partition column."""
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))
