"""Rankings of firms and categories, KPI rows, histogram and drill-down.

Every ranking is one group-by (partial sums before the shuffle, so one firm with a third of all
rows costs no more than any other) and a top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recallspark.functions import rules as R
from recallspark.functions.numbers import mean_of_cents, percent, round_even


def _class_count(label: str) -> Column:
    return F.count_if(F.col("classification") == label)


def pick_firm_column(df: DataFrame) -> str | None:
    """The first firm column with any value: one pass over both; pass the column to the rankings to
    skip it."""
    names = [name for name in ("recalling_firm", "manufacturer_name") if name in df.columns]
    if not names:
        return None
    filled = df.agg(*[F.bool_or(F.col(name).isNotNull()).alias(name) for name in names]).first()
    return next((name for name in names if filled[name]), None)


def _ranked(grouped: DataFrame, key: str, top_n: int | None) -> DataFrame:
    ranked = grouped.orderBy(F.desc("priority_score"), F.desc("total_recalls"), F.asc(key))
    return ranked if top_n is None else ranked.limit(top_n)


def manufacturer_priority(grouped: DataFrame, min_recalls: int) -> DataFrame:
    """Round the averages, derive the priority score, keep firms with enough recalls."""
    return (grouped
            .withColumns({"avg_risk_score": round_even(F.col("avg_risk_score"), 2),
                          "max_risk_score": round_even(F.col("max_risk_score"), 2)})
            .withColumn("priority_score", round_even(
                F.least(F.col("total_recalls"), F.lit(100)) * F.coalesce("avg_risk_score", F.lit(0.0)) / 10.0, 2))
            .where(F.col("total_recalls") >= min_recalls))


def top_manufacturers(df: DataFrame, min_recalls: int = 3, top_n: int | None = 20,
                      firm_column: str | None = None) -> DataFrame:
    """Firms by capped volume times average risk. Without a risk_score column the average falls
    back to severity weights."""
    firm = firm_column or pick_firm_column(df) or "recalling_firm"
    measures = [F.count("recall_number").alias("total_recalls"), _class_count("Class I").alias("class_i"),
                _class_count("Class II").alias("class_ii"), _class_count("Class III").alias("class_iii")]
    scored = "risk_score" in df.columns
    if scored:
        measures += [mean_of_cents(F.col("risk_score")).alias("avg_risk_score"),
                     F.max("risk_score").alias("max_risk_score")]
    grouped = (df.where(F.col(firm).isNotNull()).groupBy(F.col(firm).alias("manufacturer")).agg(*measures))
    if not scored:
        points = R.SEVERITY_POINTS
        average = F.try_divide(F.col("class_i") * points["Class I"] + F.col("class_ii") * points["Class II"]
                               + F.col("class_iii") * points["Class III"], F.col("total_recalls"))
        grouped = grouped.withColumn("avg_risk_score", average).withColumn("max_risk_score", average)
    return _ranked(manufacturer_priority(grouped, min_recalls), "manufacturer", top_n)


def category_priority(grouped: DataFrame) -> DataFrame:
    return (grouped.withColumn("avg_risk_score", round_even(F.col("avg_risk_score"), 2))
            .withColumn("priority_score", round_even(
                F.col("total_recalls") * F.coalesce("avg_risk_score", F.lit(0.0)) / 10.0, 2)))


def top_product_categories(df: DataFrame, category_column: str = "product_category",
                           top_n: int | None = 20) -> DataFrame:
    """Categories (the null one too) by uncapped volume times average risk."""
    measures = [F.count("recall_number").alias("total_recalls"), _class_count("Class I").alias("class_i")]
    if "risk_score" in df.columns:
        grouped = df.groupBy(category_column).agg(
            *measures, mean_of_cents(F.col("risk_score")).alias("avg_risk_score"))
    else:
        grouped = df.groupBy(category_column).agg(*measures).withColumn(
            "avg_risk_score", F.try_divide("class_i", "total_recalls") * 40.0)
    return _ranked(category_priority(grouped), category_column, top_n)


def repeat_offenders(df: DataFrame, min_class_i: int = 2, firm_column: str | None = None) -> DataFrame:
    """Firms with several Class I rows, and all their rows counted."""
    firm = firm_column or pick_firm_column(df) or "recalling_firm"
    return (df.where(F.col(firm).isNotNull()).groupBy(F.col(firm).alias("manufacturer"))
            .agg(_class_count("Class I").alias("class_i_recalls"), F.count("*").alias("total_recalls"))
            .where(F.col("class_i_recalls") >= min_class_i)
            .orderBy(F.desc("class_i_recalls"), F.asc("manufacturer")))


def top_scored(scored: DataFrame, n: int = 5) -> DataFrame:
    """The n rows with the highest score (recall number breaks ties)."""
    return scored.orderBy(F.desc("risk_score"), F.asc("recall_number")).limit(n)


def kpi_row(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total_recalls"),
        _class_count("Class I").alias("class_i"),
        F.count_distinct("recalling_firm").alias("unique_firms"),
        mean_of_cents(F.col("risk_score")).alias("avg_risk_score"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_count"))


def summary_metrics(scored: DataFrame) -> DataFrame:
    """KPI row of the report: date range as text (``n/a`` without dates), shares and tier counts."""
    row = scored.agg(
        F.count("*").alias("total_recalls"),
        F.min("report_date").alias("_first"), F.max("report_date").alias("_last"),
        F.count_distinct("recalling_firm").alias("unique_firms"),
        _class_count("Class I").alias("class_i"),
        mean_of_cents(F.col("risk_score")).alias("avg_risk_score"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_count"),
        F.count_if(F.col("risk_tier") == "High").alias("high_count"))
    return row.select(
        "total_recalls",
        F.coalesce(F.col("_first").cast("date").cast("string"), F.lit("n/a")).alias("earliest"),
        F.coalesce(F.col("_last").cast("date").cast("string"), F.lit("n/a")).alias("latest"),
        "unique_firms", "class_i",
        F.coalesce(percent(F.col("class_i"), F.col("total_recalls")), F.lit(0.0)).alias("class_i_pct"),
        F.coalesce("avg_risk_score", F.lit(0.0)).alias("avg_risk_score"), "critical_count", "high_count")


def score_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Rows per fixed-width score bin (1-based, 100 in the last) and product type."""
    bin_no = F.least(F.width_bucket("risk_score", F.lit(0.0), F.lit(100.0), F.lit(bins)), F.lit(bins).cast("long"))
    return scored.groupBy(bin_no.alias("bin"), "product_type").agg(F.count("*").alias("count"))


# fixed values: columns of the raw-data drill-down
DRILL_DOWN = ["recall_number", "product_type", "classification", "recalling_firm", "therapeutic_area",
              "product_category", "reason_category", "risk_score", "risk_tier", "report_date"]


def drill_down(scored: DataFrame) -> DataFrame:
    return scored.select(*DRILL_DOWN)
