"""Exact medians: of one positive column over a whole table, and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Bins per unit of the natural logarithm: a bin spans 0.024 % of its value.
BINS_PER_E_FOLD = 4096


def positive_median(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row with the exact median of the positive values, NULL if there are none.

    The built-in median keeps every distinct value of the table in one task.
    Here a logarithmic histogram (which keeps the order of the values) finds
    the one or two bins that hold the middle ranks, and only the distinct
    values of those bins are ranked.
    """
    counted = (
        df.where(F.col(value) > 0)
        .groupBy(F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_bin", F.floor(F.log("_value") * BINS_PER_E_FOLD))
    )
    running = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = counted.groupBy("_bin").agg(F.sum("_rows").alias("_bin_rows"))
    total = bins.agg(F.sum("_bin_rows").alias("_total"))
    # Middle ranks, counted from 1; they coincide when the count is odd.
    lower = F.floor((F.col("_total") + 1) / 2)
    upper = F.floor((F.col("_total") + 2) / 2)
    middle_bins = (
        bins.withColumn("_upto", F.sum("_bin_rows").over(running))
        .withColumn("_total", total.scalar())
        .where((F.col("_upto") >= lower) & (F.col("_upto") - F.col("_bin_rows") < upper))
        .select(
            "_bin",
            lower.alias("_lower"),
            upper.alias("_upper"),
            (F.col("_upto") - F.col("_bin_rows")).alias("_before"),
        )
    )
    in_bin = (
        Window.partitionBy("_bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    middle = (
        counted.join(middle_bins, "_bin")
        .withColumn("_upto", F.col("_before") + F.sum("_rows").over(in_bin))
        .where(
            (F.col("_upto") >= F.col("_lower")) & (F.col("_upto") - F.col("_rows") < F.col("_upper"))
        )
    )
    # One value (odd count, or both ranks equal) or two; either way their mean.
    return middle.agg(F.avg("_value").alias(name))


def grouped_middle(keys: Sequence[str], value: str, rows: Column) -> Column:
    """Whether a row holds a middle rank of its group, in a table with one row per group and value.

    ``rows`` is how many rows the value stands for. The median is the plain
    mean of the values that are marked: one, or two where the middle lies
    between them. NULL values have no rank. Running ranks replace the list of
    all values that the built-in median keeps per group.
    """
    ranked = F.when(F.col(value).isNotNull(), rows)
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, upto = F.sum(ranked).over(group), F.sum(ranked).over(running)
    lower, upper = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    return F.col(value).isNotNull() & (upto >= lower) & (upto - ranked < upper)
