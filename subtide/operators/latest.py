"""Latest row per key and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def row_fingerprint(df: DataFrame) -> Column:
    """Hash of all columns of a row, the last tie-breaker of an ordering; variants and maps count as JSON text."""
    return F.xxhash64(
        *(
            F.to_json(field.name) if isinstance(field.dataType, (T.VariantType, T.MapType)) else F.col(field.name)
            for field in df.schema.fields
        )
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order``, where NULL counts as greatest.

    Spark pushes the ``= 1`` limit below the shuffle, so every map task sends
    at most one row per key and a key with very many copies stays cheap.
    """
    newest_first = [F.col(name).desc_nulls_first() for name in order] + [row_fingerprint(df)]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn"
) -> DataFrame:
    """The first ``k`` rows of every group; ``order`` should end in a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
