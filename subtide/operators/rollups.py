"""Group totals beside every row, as an aggregate that is joined back.

A window would bring a whole group to one task; here the counts are combined
on the map side first, and only one row per group takes part in the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join ``totals`` (one row per ``keys``) to ``df``; NULL keys match."""
    renamed = totals.withColumnsRenamed({key: f"_key_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys]
    return df.join(renamed, matches, "left").drop(*(f"_key_{key}" for key in keys))


def rows_over(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """COUNT(*) OVER (PARTITION BY keys)."""
    return attach(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys)


def distinct_over(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """COUNT(DISTINCT value) OVER (PARTITION BY keys), exact."""
    totals = df.groupBy(*keys).agg(F.count_distinct(value).alias(name))
    return attach(df, totals, keys)



def distinct_counts(df: DataFrame, keys: Sequence[str], values: dict[str, str], rows: str) -> DataFrame:
    """Number of rows and exact distinct counts of several columns per group.

    ``values`` maps new columns to the columns they count. Several distinct
    counts in one aggregate would copy each row once per column. Here rows are
    reduced to the combinations that occur, once; each count then groups those
    by its own column alone, all from that one shuffle.
    """
    seen = df.groupBy(*keys, *values.values()).agg(F.count(F.lit(1)).alias("_n"))

    def counted(name: str, value: str) -> DataFrame:
        per_value = seen.groupBy(*keys, value).agg(F.sum("_n").alias("_n"))
        others = [F.lit(0).cast("bigint").alias(other) for other in values if other != name]
        grouped = per_value.groupBy(*keys).agg(F.count(value).alias(name), F.sum("_n").alias("_n"))
        return grouped.select(*keys, "_n", name, *others)

    parts = reduce(DataFrame.unionByName, (counted(name, value) for name, value in values.items()))
    return parts.groupBy(*keys).agg(F.max("_n").alias(rows), *(F.sum(name).alias(name) for name in values))
