"""Value of the previous row of a group, safe for very large groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """LAG over ``keys`` without sorting a whole group in one task.

    ``values`` maps new columns to the columns whose previous value they take.
    A group is cut into chunks by its first order column (a date). The first
    pass looks back within a chunk. Only the first row of a chunk still lacks
    its predecessor, which is the last row of an earlier chunk; so the second
    pass looks back over the first and last rows alone, at most two for each
    date of a group. All other rows ride along, spread by a hash.
    """
    ordering = [F.col(name).asc_nulls_last() for name in order]
    within = Window.partitionBy(*keys, order[0]).orderBy(*ordering)
    marked = df.withColumns(
        {
            "_opens": F.lag(F.lit(1)).over(within).isNull(),
            "_closes": F.lead(F.lit(1)).over(within).isNull(),
            **{f"_near_{name}": F.lag(source).over(within) for name, source in values.items()},
        }
    )
    spread = F.when(~(F.col("_opens") | F.col("_closes")), F.xxhash64(*order))
    across = Window.partitionBy(*keys, "_spread").orderBy(*ordering)
    joined_up = marked.withColumn("_spread", spread).withColumns(
        {
            name: F.when(F.col("_opens"), F.lag(source).over(across)).otherwise(F.col(f"_near_{name}"))
            for name, source in values.items()
        }
    )
    return joined_up.drop("_opens", "_closes", "_spread", *(f"_near_{name}" for name in values))
