"""Run-log health, data-quality and coverage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from recallspark.functions.dates import month_of
from recallspark.functions.numbers import percent
from recallspark.operators.categorize import column_or_null
from recallspark.operators.crosstabs import fill_cells

# ---- run log -----------------------------------------------------------------------


def latest_runs(log: DataFrame, n: int = 100) -> DataFrame:
    """The last n runs (a top-k, not a full sort); run id breaks ties."""
    return log.orderBy(F.desc_nulls_first("started_at"), F.asc("run_id")).limit(n)


def run_kpis(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("total_runs"),
                    F.count_if(F.col("status") == "success").alias("success_runs"),
                    F.count_if(F.col("status") == "failed").alias("failed_runs"),
                    F.avg("duration_seconds").alias("avg_duration"))


def daily_success_rate(runs: DataFrame) -> DataFrame:
    return (runs.where(F.col("started_at").isNotNull()).groupBy(F.to_date("started_at").alias("date"))
            .agg(F.count("status").alias("total"), F.count_if(F.col("status") == "success").alias("successes"))
            .withColumn("success_rate", F.try_divide("successes", "total") * 100.0)
            .orderBy("date"))


def duration_series(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("duration_seconds").isNotNull()).select("started_at", "duration_seconds", "endpoint")


def failed_runs(runs: DataFrame, endpoint: str | None = None) -> DataFrame:
    failed = runs.where(F.col("status") == "failed")
    if endpoint is not None:
        failed = failed.where(F.col("endpoint") == endpoint)
    return failed.select("started_at", "endpoint", "error_message")


def daily_validation_failures(log: DataFrame) -> DataFrame:
    return (log.where(F.col("started_at").isNotNull()).groupBy(F.to_date("started_at").alias("date"))
            .agg(F.sum("validation_failures").alias("failures")).orderBy("date"))


# ---- data quality ------------------------------------------------------------------

# fixed values: columns of the null-rate check; the second list counts "" as missing too
NULL_RATE_COLUMNS = ["classification", "product_description", "distribution_pattern", "report_date",
                     "recall_initiation_date", "brand_name", "generic_name", "code_info", "product_quantity"]
EMPTY_IS_NULL = ["product_description", "code_info"]
NULL_RATE_LIMIT = 10.0


def validation_totals(recalls: DataFrame) -> DataFrame:
    return (recalls.agg(F.count("*").alias("total"), F.count_if("is_validated").alias("validated"))
            .withColumn("unvalidated", F.col("total") - F.col("validated")))


def null_rates(recalls: DataFrame) -> DataFrame:
    """Percent missing per key column, with the 10 % flag; one aggregate row turned on its side."""
    def missing(name):
        value = column_or_null(recalls, name)
        return value.isNull() | (value == "") if name in EMPTY_IS_NULL else value.isNull()

    counts = recalls.agg(F.count("*").alias("_total"), *[F.count_if(missing(c)).alias(c) for c in NULL_RATE_COLUMNS])
    return (counts.unpivot("_total", NULL_RATE_COLUMNS, "column", "_missing")
            .select("column", F.coalesce(percent(F.col("_missing"), F.col("_total")), F.lit(0.0)).alias("null_pct"))
            .withColumn("over_limit", F.col("null_pct") > NULL_RATE_LIMIT)
            .orderBy("null_pct", "column"))


def daily_anomalies(recalls: DataFrame, min_days: int = 7) -> DataFrame:
    """Records per day with mean +- 2 sample deviations; nothing unless there are more than
    min_days days. The un-keyed window runs on one row per calendar day."""
    daily = (recalls.where(F.col("report_date").isNotNull()).groupBy(F.col("report_date").alias("date"))
             .agg(F.count("*").alias("record_count")))
    everything = W.partitionBy()
    mean, dev = F.avg("record_count").over(everything), F.stddev_samp("record_count").over(everything)
    bounded = daily.select("date", "record_count", (mean + 2 * dev).alias("upper_bound"),
                           (mean - 2 * dev).alias("_lower"), F.count("*").over(everything).alias("_days"))
    return (bounded.where(F.col("_days") > min_days)
            .select("date", "record_count", "upper_bound",
                    F.greatest(F.lit(0.0), F.col("_lower")).alias("lower_bound"),
                    ((F.col("record_count") > F.col("upper_bound"))
                     | (F.col("record_count") < F.col("_lower"))).alias("is_anomaly"))
            .orderBy("date"))


# ---- coverage ----------------------------------------------------------------------


def monthly_coverage(recalls: DataFrame, by: str = "product_type") -> DataFrame:
    return (recalls.where(F.col("report_date").isNotNull())
            .groupBy(month_of(F.col("report_date")).alias("month"), by)
            .agg(F.count("*").alias("record_count")).orderBy("month", by))


def staleness(recalls: DataFrame) -> DataFrame:
    return (recalls.groupBy("product_type", "source")
            .agg(F.max("report_date").alias("latest_date"), F.count("*").alias("total_records"))
            .orderBy("product_type", "source"))


def coverage_summary(recalls: DataFrame) -> DataFrame:
    return recalls.where(F.col("report_date").isNotNull()).agg(
        F.min("report_date").alias("earliest"), F.max("report_date").alias("latest"),
        F.count("*").alias("total"), F.count_distinct("product_type").alias("types"))


def coverage_matrix(recalls: DataFrame) -> DataFrame:
    """Product type by observed month, zeros filled in (long form)."""
    cells = monthly_coverage(recalls).where(F.col("product_type").isNotNull())
    return fill_cells(cells, "product_type", "month", "record_count")


def coverage_gaps(recalls: DataFrame) -> DataFrame:
    """Months without a record per product type, between the first and last month of any type."""
    month = month_of(F.col("report_date"))
    spine = F.sequence(recalls.agg(F.min(month)).scalar(), recalls.agg(F.max(month)).scalar(), F.expr("interval 1 month"))
    per_type = (recalls.where(F.col("report_date").isNotNull()).groupBy("product_type")
                .agg(F.collect_set(month).alias("_seen")))
    return per_type.select("product_type", F.explode(F.array_except(spine, "_seen")).alias("missing_month"))
