"""Customer health scores. All thresholds sit here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHTS = {"license": 0.40, "revenue": 0.30, "engagement": 0.30}


def license_score(active: Column, days_since_end: Column) -> Column:
    return F.when(active, 100).when(days_since_end <= 30, 50).otherwise(0)


def revenue_score(amount: Column, median: Column) -> Column:
    """Revenue against the median of paying workspaces; no median scores 25."""
    paid = F.coalesce(amount, F.lit(0.0))
    return (
        F.when(paid == 0, 0)
        .when(paid >= median * 2, 100)
        .when(paid >= median, 75)
        .when(paid >= median * 0.5, 50)
        .otherwise(25)
    )


def engagement_score(features: Column) -> Column:
    used = F.coalesce(features, F.lit(0))
    return F.when(used >= 5, 100).when(used >= 3, 75).when(used >= 1, 50).otherwise(0)


def health_score(license_part: Column, revenue_part: Column, engagement_part: Column) -> Column:
    weighted = (
        license_part * F.lit(WEIGHTS["license"])
        + revenue_part * F.lit(WEIGHTS["revenue"])
        + engagement_part * F.lit(WEIGHTS["engagement"])
    )
    return F.round(weighted, 1)


def health_segment(score: Column) -> Column:
    return F.when(score >= 75, "healthy").when(score >= 50, "at_risk").otherwise("churned_or_inactive")
