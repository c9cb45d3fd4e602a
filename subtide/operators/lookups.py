"""Lookups against reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.text import country_code


def with_country_code(
    df: DataFrame, countries: DataFrame, country: str = "country", name: str = "country_iso"
) -> DataFrame:
    """Add the ISO code of a free-text country, the cleaned name if unknown.

    The country list is left without a hint: Spark broadcasts it as long as
    its measured size stays under the broadcast threshold.
    """
    names = countries.select(
        F.lower(F.trim("country_name")).alias("_country_name"), F.col("iso_code").alias("_iso_code")
    )
    matched = df.join(names, F.lower(F.trim(F.col(country))) == F.col("_country_name"), "left")
    coded = matched.withColumn(name, country_code(F.col("_iso_code"), F.col(country)))
    return coded.drop("_country_name", "_iso_code")


def left_join_split(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """LEFT join for keys that repeat or are missing very often, on either side.

    Spark splits a hot key on both sides of an inner join, but only on the
    left of a LEFT join. So matches come from an inner join, and the other
    left rows from an anti join against the distinct right keys. NULL keys
    match nothing but would all hash to one task; a slot number joined along
    with the key spreads them by the hash of ``spread_by``. The left side is
    shuffled once for both joins.
    """
    slot = F.when(F.col(key).isNull(), F.coalesce(F.pmod(F.xxhash64(spread_by), F.lit(4096)), F.lit(0))).otherwise(
        F.lit(0)
    ).cast("bigint")
    keyed = left.withColumn("_key", F.struct(F.col(key).alias("key"), slot.alias("slot")))
    others = (
        right.where(F.col(key).isNotNull())
        .withColumn("_key", F.struct(F.col(key).alias("key"), F.lit(0).cast("bigint").alias("slot")))
        .drop(key)
    )
    matched = keyed.join(others, "_key")
    alone = keyed.join(others.select("_key").distinct(), "_key", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True).drop("_key")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their number of rows. NULL is no value.

    Children are counted per value before the join, so a value that very many
    rows share crosses the network once per map task.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return counted.join(known, "value", "left_anti")
