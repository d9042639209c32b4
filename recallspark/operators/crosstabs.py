"""Contingency tables, the chi-square test and the reach/score correlation.

Wide tables over a known value list are conditional counts in one group-by. The value lists of
the long tables are found in the (tiny) counted cells, so no row set is ever crossed with another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from recallspark.functions import rules as R
from recallspark.functions.numbers import round_even
from recallspark.functions.pvalues import chi_square_p, pearson_p
from recallspark.functions.scoring import reach_bucket, state_reach


def fill_cells(cells: DataFrame, row: str, column: str, count: str = "count") -> DataFrame:
    """Counted (row, column, count) cells completed with zeros for the pairs not seen."""
    labels = F.array_sort(F.collect_set(column).over(W.partitionBy()))
    per_row = (cells.withColumn("_labels", labels).groupBy(row)
               .agg(F.map_from_entries(F.collect_list(F.struct(column, count))).alias("_counts"),
                    F.first("_labels").alias("_labels")))
    return (per_row.select(row, "_counts", F.explode("_labels").alias(column))
            .select(row, column, F.coalesce(F.try_element_at("_counts", F.col(column)),
                                            F.lit(0).cast("long")).alias(count)))


def unclassified_as_label(c: Column) -> Column:
    return F.coalesce(c, F.lit(R.UNCLASSIFIED))


def type_by_classification(df: DataFrame) -> DataFrame:
    """Long crosstab of product type and classification, zeros included."""
    cells = (df.where(F.col("product_type").isNotNull())
             .groupBy("product_type", unclassified_as_label(F.col("classification")).alias("classification"))
             .agg(F.count("*").alias("count")))
    return fill_cells(cells, "product_type", "classification")


def type_by_state(df: DataFrame, types: list[str] = R.PRODUCT_TYPES) -> DataFrame:
    """Two-letter states by product type, with a row total, largest first."""
    counts = [F.count_if(F.col("product_type") == t).alias(t) for t in types]
    return (df.where((F.length("state") == 2) & F.col("product_type").isin(*types))
            .groupBy("state").agg(*counts, F.count("*").alias("total"))
            .orderBy(F.desc("total"), F.asc("state")))


def with_reach(df: DataFrame) -> DataFrame:
    """The frame with its state_reach column, computed once per row when not there yet. No filter
    follows on values derived from it: a filter would be pushed below and compute it again."""
    return df if "state_reach" in df.columns else df.withColumn("state_reach", state_reach(F.col("distribution_pattern")))


def severity_by_reach(df: DataFrame) -> DataFrame:
    """Classification by reach bucket; all five buckets are always present as columns."""
    bucketed = with_reach(df).select(unclassified_as_label(F.col("classification")).alias("classification"),
                                     reach_bucket(F.col("state_reach")).alias("_bucket"))
    return (bucketed.groupBy("classification")
            .agg(F.count("_bucket").alias("_in_range"),
                 *[F.count_if(F.col("_bucket") == b).alias(b) for b, _ in R.REACH_BUCKETS])
            .where(F.col("_in_range") > 0).drop("_in_range").orderBy("classification"))


def reason_shares(cells: DataFrame, types: list[str] = R.PRODUCT_TYPES) -> DataFrame:
    """Percent of each product type's rows per reason, from (reason_category, product_type, n)."""
    share = round_even(F.col("n") / F.sum("n").over(W.partitionBy("product_type")) * 100.0, 1)
    return (cells.withColumn("_share", share).groupBy("reason_category")
            .agg(*[F.coalesce(F.max(F.when(F.col("product_type") == t, F.col("_share"))), F.lit(0.0)).alias(t)
                   for t in types])
            .orderBy("reason_category"))


def reason_by_product_type(df: DataFrame, types: list[str] = R.PRODUCT_TYPES) -> DataFrame:
    cells = (df.where(F.col("reason_category").isNotNull() & F.col("product_type").isin(*types))
             .groupBy("reason_category", "product_type").agg(F.count("*").alias("n")))
    return reason_shares(cells, types)


def chi_square_of_cells(cells: DataFrame) -> DataFrame:
    """Independence test from (reason_category, classification, n) cells; one row.

    Only the observed cells are needed: sum (o-e)^2/e over the full table equals
    N * (sum o^2/(row*column) - 1). With one degree of freedom all four |o-e| are alike, so the
    continuity correction follows from the largest of them and the reciprocals of the margins.
    """
    row, column, all_cells = W.partitionBy("reason_category"), W.partitionBy("classification"), W.partitionBy()
    margins = cells.select("reason_category", "classification", F.col("n").cast("double").alias("o"),
                           F.sum("n").over(row).cast("double").alias("r"),
                           F.sum("n").over(column).cast("double").alias("c"),
                           F.sum("n").over(all_cells).cast("double").alias("t"))
    sums = margins.agg(
        F.coalesce(F.max("t"), F.lit(0.0)).cast("long").alias("n"),
        F.count_distinct("reason_category").alias("_rows"), F.count_distinct("classification").alias("_cols"),
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("_s"),
        F.max(F.abs(F.col("o") - F.col("r") * F.col("c") / F.col("t"))).alias("_gap"),
        F.sum(F.col("o") / (F.col("r") * F.col("r"))).alias("_inv_rows"),
        F.sum(F.col("o") / (F.col("c") * F.col("c"))).alias("_inv_cols"))
    dof = ((F.col("_rows") - 1) * (F.col("_cols") - 1)).cast("int")
    usable = (F.col("n") >= 10) & (dof > 0)
    left = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    statistic = F.when(dof == 1, left * left * F.col("n") * F.col("_inv_rows") * F.col("_inv_cols")).otherwise(
        F.greatest(F.lit(0.0), F.col("n") * (F.col("_s") - 1.0)))
    tested = sums.select(F.when(usable, statistic).alias("_x"), F.when(usable, dof).alias("dof"), "n")
    verdict = (F.when(F.col("n") < 10, "insufficient data")
               .when(F.col("dof").isNull(), "insufficient variation")
               .when(F.col("_p") < 0.05, "statistically significant association (p<0.05)")
               .otherwise("no significant association (p≥0.05)"))
    return (tested.withColumn("_p", chi_square_p("_x", "dof"))
            .select(round_even(F.col("_x"), 3).alias("statistic"), round_even(F.col("_p"), 4).alias("p_value"),
                    "dof", F.when(F.col("dof").isNotNull(), F.col("n")).alias("n"),
                    verdict.alias("interpretation")))


def chi_square_reason_vs_severity(df: DataFrame) -> DataFrame:
    cells = (df.where(F.col("reason_category").isNotNull() & F.col("classification").isNotNull())
             .groupBy("reason_category", "classification").agg(F.count("*").alias("n")))
    return chi_square_of_cells(cells)


def pearson_of_cells(cells: DataFrame) -> DataFrame:
    """Correlation of counted (reach, cents, rows) cells; one row, null r and p under three pairs.

    The moments are whole numbers, summed as decimals in one aggregate: the same in any task order, and a
    constant column has a spread of exactly zero (null r). The quotient is written out, since the built-in
    ``corr`` raises on a constant column in ANSI mode.
    """
    pairs = cells.where(F.col("reach").isNotNull() & F.col("cents").isNotNull())
    x, y, n = (F.col(c).cast(f"decimal({digits},0)") for c, digits in (("reach", 9), ("cents", 9), ("rows", 19)))
    sums = pairs.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), *[
        F.coalesce(F.sum(value * n), F.lit(0)).cast("decimal(38,0)").alias(name)
        for name, value in {"_x": x, "_y": y, "_xy": x * y, "_xx": x * x, "_yy": y * y}.items()])

    def spread(ab: str, a: str, b: str) -> Column:
        return F.col("n").cast("decimal(19,0)") * F.col(ab) - F.col(a) * F.col(b)

    xy, xx, yy = (spread(*names).cast("double") for names in (("_xy", "_x", "_y"), ("_xx", "_x", "_x"), ("_yy", "_y", "_y")))
    r = F.when(F.col("n") >= 3, F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)))
    return (sums.select(r.alias("_r"), "n").withColumn("_p", pearson_p("_r", "n"))
            .select(round_even(F.col("_r"), 3).alias("r"), round_even(F.col("_p"), 4).alias("p_value"),
                    F.when(F.col("n") >= 3, F.col("n")).alias("n")))


def pearson_reach_vs_score(df: DataFrame) -> DataFrame:
    """Correlation of state reach and risk score, over the counted pairs of the two."""
    cents = F.rint(F.col("risk_score") * 100).cast("long")
    return pearson_of_cells(with_reach(df).groupBy(F.col("state_reach").alias("reach"), cents.alias("cents"))
                            .agg(F.count("*").alias("rows")))
