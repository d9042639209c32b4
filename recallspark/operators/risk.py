"""Risk scoring of recall rows and the tier distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recallspark.functions import rules as R
from recallspark.functions.scoring import risk_score, risk_tier, state_reach


def score(recalls: DataFrame, keep_reach: bool = False) -> DataFrame:
    """Add risk_score and risk_tier (and, on request, the state_reach both rest on)."""
    scored = (recalls.withColumn("state_reach", state_reach(F.col("distribution_pattern")))
              .withColumn("risk_score", risk_score(F.col("classification"), F.col("state_reach"),
                                                   F.col("product_quantity"), F.col("status")))
              .withColumn("risk_tier", risk_tier(F.col("risk_score"))))
    return scored if keep_reach else scored.drop("state_reach")


def tier_distribution(scored: DataFrame) -> DataFrame:
    """Four rows in fixed order, zero where a tier is empty: one aggregate turned on its side."""
    tiers = [t for t, _ in R.TIERS]
    wide = scored.agg(*[F.count_if(F.col("risk_tier") == t).alias(t) for t in tiers])
    return wide.unpivot([], tiers, "risk_tier", "count")
