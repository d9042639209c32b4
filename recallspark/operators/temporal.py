"""Time series of recall counts. Gaps are not filled; rows without a usable date are left out.

The windows without a partition key run on tables already aggregated to one row per calendar
month, so their size is set by the calendar and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from recallspark.functions.dates import month_of, season_of, season_order
from recallspark.functions.numbers import round_even


def _dated(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn("_day", F.col(date_column).try_cast("date")).where(F.col("_day").isNotNull())


def _counts(df: DataFrame, date_column: str, period: Column, name: str, by: str | None) -> DataFrame:
    dated = _dated(df, date_column)
    keys = [period.alias(name)]
    if by:
        dated = dated.where(F.col(by).isNotNull())
        keys.append(F.col(by))
    return dated.groupBy(*keys).agg(F.count("*").alias("count"))


def monthly_counts(df: DataFrame, by: str | None = "product_type", date_column: str = "report_date") -> DataFrame:
    counts = _counts(df, date_column, month_of(F.col("_day")), "month", by)
    return counts.orderBy("month", *([by] if by else []))


def quarterly_counts(df: DataFrame, by: str | None = "product_type", date_column: str = "report_date") -> DataFrame:
    label = F.concat(F.year("_day").cast("string"), F.lit("Q"), F.quarter("_day").cast("string"))
    return _counts(df, date_column, label, "quarter", by).orderBy("quarter", *([by] if by else []))


def yearly_counts(df: DataFrame, by: str | None = "product_type", date_column: str = "report_date") -> DataFrame:
    return _counts(df, date_column, F.year("_day"), "year", by).orderBy("year", *([by] if by else []))


def seasonal_counts(df: DataFrame, by: str | None = "product_type", date_column: str = "report_date") -> DataFrame:
    counts = _counts(df, date_column, season_of(F.col("_day")), "season", by)
    return counts.orderBy(season_order(F.col("season")), *([by] if by else []))


def profile_of_months(monthly: DataFrame) -> DataFrame:
    """Mean and sample deviation per month of the year, from (month, count) rows."""
    return (monthly.groupBy(F.month("month").alias("month_num"))
            .agg(F.avg("count").alias("mean"), F.coalesce(F.stddev_samp("count"), F.lit(0.0)).alias("std"))
            .withColumn("month_name", F.date_format(F.make_date(F.lit(2000), "month_num", F.lit(1)), "MMM"))
            .orderBy("month_num"))


def month_of_year_profile(df: DataFrame, date_column: str = "report_date") -> DataFrame:
    return profile_of_months(monthly_counts(df, None, date_column))


def trend_of_months(monthly: DataFrame) -> DataFrame:
    """One row: least-squares line over the observed-month ordinal 0..n-1."""
    at = F.row_number().over(W.orderBy("month")) - 1
    fit = monthly.select(at.alias("x"), F.col("count").cast("double").alias("y")).agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.avg("y").alias("mean"), F.count("*").alias("n_months"))
    enough = F.col("n_months") >= 3
    return fit.select(F.when(enough, F.col("slope")).otherwise(0.0).alias("slope"),
                      F.when(enough, F.col("intercept")).alias("intercept"),
                      F.when(enough, F.col("mean")).otherwise(0.0).alias("mean"), "n_months")


def trend(df: DataFrame, date_column: str = "report_date") -> DataFrame:
    return trend_of_months(monthly_counts(df, None, date_column))


def spikes_of_months(monthly: DataFrame, z_threshold: float = 2.0) -> DataFrame:
    """z-score (population deviation) per month, flagged on the rounded value."""
    everything = W.partitionBy()
    enough = F.count("*").over(everything) >= 3
    deviation = F.nullif(F.stddev_pop("count").over(everything), F.lit(0.0))
    z = round_even((F.col("count") - F.avg("count").over(everything)) / deviation, 2)
    return (monthly.select("month", "count", F.coalesce(F.when(enough, z), F.lit(0.0)).alias("z_score"),
                           enough.alias("_enough"))
            .withColumn("is_spike", F.col("_enough") & (F.abs("z_score") >= z_threshold))
            .drop("_enough").orderBy("month"))


def spike_detection(df: DataFrame, z_threshold: float = 2.0, date_column: str = "report_date") -> DataFrame:
    return spikes_of_months(monthly_counts(df, None, date_column), z_threshold)
