"""Spread a payment over the months it covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.dates import months_apart


def month_spread(
    df: DataFrame, origin: str, start: str, name: str, covered: int = 12, periods: int = 24
) -> DataFrame:
    """One row per covered month, counted from ``origin``.

    A payment of month ``start`` covers ``covered`` months. Months before the
    origin and from ``origin + periods`` on are left out, and rows without any
    month in range disappear. The range is generated per row, not joined.
    """
    offset = months_apart(F.col(origin), F.col(start))
    bounded = df.withColumns(
        {
            "_from": F.greatest(offset, F.lit(0)),
            "_to": F.least(offset + (covered - 1), F.lit(periods - 1)),
        }
    ).where("_from <= _to")
    return (
        bounded.withColumn("_month", F.explode(F.sequence("_from", "_to")))
        .withColumn(name, F.add_months(F.col(origin), F.col("_month")))
        .drop("_from", "_to", "_month")
    )
