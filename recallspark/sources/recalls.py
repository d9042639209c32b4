"""Scans of the stored tables: the filtered analytics scan and the firm scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from recallspark.schemas import ANALYTICS_COLUMNS, FIRM_SCAN_COLUMNS, record_type
from recallspark.sources.store import read_table


def load_recalls(recalls: DataFrame, start: date | None = None, end: date | None = None,
                 product_type: str | None = None, ordered: bool = True) -> DataFrame:
    """The analytics columns of the recalls in a date range, newest report first.

    A row whose two dates are both null fails any date filter. The date test is written as
    "report date in range, or no report date and initiation date in range", so that each half is a
    plain comparison the parquet reader can use; a filter on ``coalesce`` would not be pushed down.
    The recall number breaks ties, which also lets the range sort split a day that holds many rows.
    """
    kept = recalls
    if product_type is not None:
        kept = kept.where(F.col("product_type") == product_type)
    if start is not None or end is not None:
        def within(c):
            tests = ([c >= F.lit(start)] if start is not None else []) + ([c <= F.lit(end)] if end is not None else [])
            return tests[0] if len(tests) == 1 else tests[0] & tests[1]
        reported, begun = F.col("report_date"), F.col("recall_initiation_date")
        kept = kept.where(within(reported) | (reported.isNull() & within(begun)))
        if "report_month" in recalls.columns:  # undated rows lie in the partition without a month
            month = F.col("report_month")
            bounds = ([month >= F.lit(start.replace(day=1))] if start is not None else []) + ([month <= F.lit(end)] if end is not None else [])
            kept = kept.where(month.isNull() | (bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]))
    known = set(recalls.columns)
    scan = kept.select(*[F.col(c) if c in known else F.lit(None).cast(record_type(c)).alias(c)
                         for c in ANALYTICS_COLUMNS])
    if ordered:
        scan = scan.orderBy(F.desc_nulls_first("report_date"), F.asc("recall_number"))
    return scan


def load_firms(firms: DataFrame) -> DataFrame:
    return firms.select(*FIRM_SCAN_COLUMNS)


def read_recalls(spark: SparkSession, path: str) -> DataFrame:
    """The stored recall table (partitioned by product type and report month)."""
    return read_table(spark, path)
