"""Column builders of the 0-100 risk score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recallspark.functions import rules as R
from recallspark.functions.numbers import round_even
from recallspark.functions.text import parse_quantity, state_reach


def _lookup(key: Column, table: dict, default) -> Column:
    chain = F
    for value, result in table.items():
        chain = chain.when(key == value, F.lit(result))
    return chain.otherwise(F.lit(default))


def severity_rank(classification: Column) -> Column:
    return _lookup(classification, R.SEVERITY_RANK, 0)


def reach_points(reach: Column) -> Column:
    return (F.when(reach >= 10, R.REACH_POINTS_WIDE)
            .when(reach >= 2, R.REACH_POINTS_SEVERAL)
            .when(reach == 1, R.REACH_POINTS_ONE)
            .otherwise(R.REACH_POINTS_NONE))


def quantity_points(quantity: Column) -> Column:
    """Log scale: 1 unit gives 0 points, a million or more the maximum."""
    number = parse_quantity(quantity).cast("double")
    points = F.log10(number) / 6.0 * float(R.QUANTITY_POINTS_MAX)
    return F.when(number > 0, F.least(F.lit(float(R.QUANTITY_POINTS_MAX)), F.greatest(F.lit(0.0), points))
                  ).otherwise(F.lit(0.0))


def risk_score(classification: Column, reach: Column, quantity: Column, status: Column) -> Column:
    raw = (_lookup(classification, R.SEVERITY_POINTS, R.SEVERITY_POINTS_UNKNOWN)
           + reach_points(reach) + quantity_points(quantity))
    final = raw * _lookup(status, R.STATUS_FACTOR, R.STATUS_FACTOR_UNKNOWN)
    return round_even(F.least(F.lit(100.0), F.greatest(F.lit(0.0), final)), 2)


def risk_tier(score: Column) -> Column:
    chain = F
    for tier, lower in R.TIERS[:-1]:
        chain = chain.when(score >= lower, tier)
    return chain.otherwise(R.TIERS[-1][0])


def reach_bucket(reach: Column) -> Column:
    """Bucket label; null above the last bound."""
    chain = F
    for label, upper in R.REACH_BUCKETS:
        chain = chain.when(reach <= upper, label)
    return chain


__all__ = ["severity_rank", "reach_points", "quantity_points", "risk_score", "risk_tier", "reach_bucket",
           "state_reach"]
