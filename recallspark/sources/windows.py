"""Date windows that drive the ingest jobs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from recallspark.functions import rules as R

BACKFILL_START_YEAR = 2020   # fixed value
DAILY_LOOKBACK_DAYS = 7      # fixed value


def backfill_windows(spark: SparkSession, as_of: date, start_year: int | None = None, end_year: int | None = None,
                     product_types: list[str] | None = None) -> DataFrame:
    """One row per month and product type with its first and last day as ``yyyyMMdd``. Months after
    as_of's are left out only in as_of's own year, so a later end year keeps its months."""
    first = date(start_year or BACKFILL_START_YEAR, 1, 1)
    last = date(end_year or as_of.year, 12, 1)
    months = spark.range(1).select(F.explode(F.sequence(
        F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("_month")) if first <= last else \
        spark.range(0).select(F.lit(first).alias("_month"))
    future = (F.year("_month") == as_of.year) & (F.month("_month") > as_of.month)
    types = F.array(*[F.lit(t) for t in (product_types or R.PRODUCT_TYPES)])
    return months.where(~future).select(
        F.year("_month").alias("year"), F.month("_month").alias("month"), F.explode(types).alias("product_type"),
        F.date_format("_month", "yyyyMMdd").alias("date_from"),
        F.date_format(F.last_day("_month"), "yyyyMMdd").alias("date_to"))


def daily_window(as_of: date, lookback_days: int = DAILY_LOOKBACK_DAYS) -> tuple[date, date]:
    return as_of - timedelta(days=lookback_days), as_of
