"""Date windows over partitioned data.

"Today" is always a parameter (never the wall clock inside a job), so a
rerun after an executor loss sees the same days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_today(tz: str = "America/New_York", now_utc: dt.datetime | None = None) -> dt.date:
    """The calendar date in ``tz`` at ``now_utc`` (driver side, once per job)."""
    from zoneinfo import ZoneInfo
    now = now_utc or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(ZoneInfo(tz)).date()


def last_days(spark: SparkSession, today: dt.date, n: int = 7) -> DataFrame:
    """The n calendar days before ``today`` (today excluded), newest first."""
    return spark.range(1, n + 1).select(F.date_sub(F.lit(today), F.col("id").cast("int")).alias("day"))


def latest_available(available: DataFrame, day: str, today: dt.date, lookback: int = 4) -> DataFrame:
    """The newest day present within ``lookback`` days before today."""
    lo, hi = today - dt.timedelta(days=lookback), today - dt.timedelta(days=1)
    return available.where(F.col(day).between(F.lit(lo), F.lit(hi))).agg(F.max(day).alias("day"))


def missing_days(wanted: DataFrame, available: DataFrame, day: str = "day") -> DataFrame:
    """D3: requested days with no data (skipped, not fatal)."""
    have = available.select(F.col(day).alias("day")).distinct()
    return wanted.join(have, "day", "left_anti")


def landed_days(spark: SparkSession, path: str, column: str = "day") -> DataFrame:
    """The days that have a file under ``<path>/<column>=YYYY-MM-DD/``.

    Folders are listed and no file is opened: the scan's read schema is empty
    and only the partition column is used, so a filter on ``day`` is a
    partition filter."""
    return spark.read.format("binaryFile").load(path).select(F.col(column).cast("date").alias("day")).distinct()


def latest_landed(spark: SparkSession, path: str, today: dt.date, lookback: int = 4, column: str = "day") -> DataFrame:
    """D2 by folders: the newest landed day within ``lookback`` days before today (NULL if none)."""
    return latest_available(landed_days(spark, path, column), "day", today, lookback)


def within_days(scan: DataFrame, today: dt.date, n: int = 7, column: str = "day") -> DataFrame:
    """All landed days of the n before today in one scan; days that did not
    land are just absent. The bounds are literals on the partition column, so
    the other folders are pruned before any file is opened."""
    return scan.where(F.col(column).between(F.lit(today - dt.timedelta(days=n)), F.lit(today - dt.timedelta(days=1))))
