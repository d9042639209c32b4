"""Keyword categorisation and category summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recallspark.functions import rules as R
from recallspark.functions.numbers import percent
from recallspark.functions.scoring import severity_rank
from recallspark.functions.text import blank_to_null, first_match, join_filled, title_case


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def therapeutic_area(text: Column) -> Column:
    return first_match(F.lower(text), R.THERAPEUTIC_AREAS)


def device_type(text: Column) -> Column:
    return first_match(F.lower(text), R.DEVICE_TYPES)


def food_type(text: Column) -> Column:
    return first_match(F.lower(text), R.FOOD_TYPES)


def reason_category(reason: Column) -> Column:
    return F.when(blank_to_null(reason).isNull(), R.UNKNOWN).otherwise(
        first_match(F.lower(reason), R.RECALL_REASONS))


def categorize(recalls: DataFrame) -> DataFrame:
    """Add therapeutic_area, product_category, reason_category and severity_rank.

    Only the taxonomy of the row's product type is tried. Its search text is built and lower-cased
    once, in a projection of its own, rather than once per rule.
    """
    generic, brand, substance, description, reason, route = (
        column_or_null(recalls, c) for c in ("generic_name", "brand_name", "substance_name",
                                             "product_description", "reason_for_recall", "route"))
    kind = F.col("product_type")
    searched = (F.when(kind == "Drugs", join_filled(generic, brand, substance, description, reason))
                .when(kind == "Devices", join_filled(description, brand, reason))
                .when(kind == "Food", join_filled(description, reason)))
    blob = F.col("_search_text")
    return (recalls.withColumn("_search_text", F.lower(searched))
            .withColumns({
                "therapeutic_area": F.when(kind == "Drugs", first_match(blob, R.THERAPEUTIC_AREAS)
                                           ).otherwise(R.NOT_APPLICABLE),
                "product_category": F.when(
                    kind == "Drugs", F.coalesce(title_case(blank_to_null(route)), F.lit(R.NO_ROUTE)))
                .when(kind == "Devices", first_match(blob, R.DEVICE_TYPES))
                .when(kind == "Food", first_match(blob, R.FOOD_TYPES))
                .otherwise(R.OTHER),
                "reason_category": reason_category(reason),
                "severity_rank": severity_rank(F.col("classification")),
            })
            .drop("_search_text"))


def summary_by(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Totals, Class I totals and Class I share per value of a column (the null value kept)."""
    grouped = df.groupBy(column).agg(
        F.count("recall_number").alias("total_recalls"),
        F.count_if(F.col("classification") == "Class I").alias("class_i_recalls"),
    ).withColumn("class_i_pct", percent(F.col("class_i_recalls"), F.col("total_recalls")))
    return grouped.orderBy(F.desc("total_recalls"), F.asc(column)) if ordered else grouped
