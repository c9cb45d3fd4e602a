"""Customer hub and product usage, bridged by company name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.dates import month_of
from subtide.functions.text import company_key
from subtide.operators.lookups import left_join_split, with_country_code
from subtide.operators.rollups import distinct_counts

BRIDGE = ["event_month", "product", "event_type", "company_key"]


def customers(licenses: DataFrame, countries: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """One row per workspace.

    Licenses are first reduced to one row per workspace and add-on, so the
    distinct counts and the product list need no second pass over the rows.
    """
    per_addon = (
        with_country_code(licenses, countries)
        .groupBy("host_license_id", "addon_key")
        .agg(
            F.max("is_active").alias("is_active"),
            *(
                F.max(name).alias(name)
                for name in ("cloud_id", "hosting", "company", "country_iso", "last_updated")
            ),
        )
    )
    hub = per_addon.groupBy("host_license_id").agg(
        F.max("cloud_id").alias("cloud_id"),
        F.max("hosting").alias("hosting"),
        F.max("country_iso").alias("country_iso"),
        F.max("company").alias("company"),
        F.max("is_active").alias("has_active_license"),
        F.count("addon_key").alias("product_count"),
        F.count(F.when(F.col("is_active"), F.col("addon_key"))).alias("product_count_active"),
        F.sort_array(F.collect_list("addon_key")).alias("products"),
        F.max("last_updated").alias("last_updated"),
    )
    return hub.select(
        F.col("host_license_id").alias("instance_id"),
        "cloud_id",
        "host_license_id",
        "hosting",
        "country_iso",
        company_key(F.col("company"), F.col("country_iso"), suffixes).alias("company_key"),
        "has_active_license",
        "product_count",
        "product_count_active",
        "products",
        "last_updated",
    )


def keyed_events(events: DataFrame, countries: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Events of real users with their month and company key."""
    real = events.where(~F.col("is_bot") & ~F.col("is_test_event"))
    return with_country_code(real, countries).select(
        "event_id",
        "event_type",
        "event_time",
        month_of(F.col("event_time")).alias("event_month"),
        "user_id",
        "device_id",
        "session_id",
        "product",
        "is_anonymous",
        F.col("country_iso").alias("country"),
        company_key(F.col("user_property_company"), F.col("country_iso"), suffixes).alias("company_key"),
    )


def bridge(keyed: DataFrame, hub: DataFrame, spread_by: str = "event_type") -> DataFrame:
    """Attach workspaces by company key.

    A key shared by several workspaces repeats the row for each of them. Rows
    without a key are spread over tasks by ``spread_by``.
    """
    workspaces = hub.select("company_key", "instance_id")
    joined = left_join_split(keyed, workspaces, "company_key", spread_by)
    return joined.withColumn("is_matched", F.col("instance_id").isNotNull())


def feature_usage(keyed: DataFrame, hub: DataFrame) -> DataFrame:
    """Usage per month, product, event type and workspace.

    All workspaces of a company key see the same events, so usage is counted
    per key before the bridge: the join carries one row per group instead of
    one per event, and events without a company shrink to a few rows.
    """
    rows = keyed.withColumn("anonymous_device", F.when(F.col("is_anonymous"), F.col("device_id")))
    distinct = {"unique_users": "user_id", "unique_sessions": "session_id", "anonymous_device_count": "anonymous_device"}
    counted = distinct_counts(rows, BRIDGE, distinct, "event_count")
    return bridge(counted, hub).select(
        *BRIDGE,
        "instance_id",
        "is_matched",
        "event_count",
        "unique_users",
        "unique_sessions",
        "anonymous_device_count",
    )


def match_rate(keyed: DataFrame, hub: DataFrame) -> DataFrame:
    """Share of events with a company that find a workspace, and the fan-out."""
    per_key = keyed.where(F.col("company_key").isNotNull()).groupBy("company_key").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    spaces = (
        hub.where(F.col("company_key").isNotNull() & F.col("instance_id").isNotNull())
        .groupBy("company_key")
        .agg(F.count(F.lit(1)).alias("n_workspaces"))
    )
    joined = per_key.join(spaces, "company_key", "left")
    matched = F.col("n_workspaces").isNotNull()
    return joined.agg(
        F.sum("n_events").alias("keyed_events"),
        F.sum(F.when(matched, F.col("n_events")).otherwise(0)).alias("matched_events"),
        F.sum(F.col("n_events") * F.coalesce("n_workspaces", F.lit(1))).alias("bridged_rows"),
        (
            F.sum(F.when(matched, F.col("n_events")).otherwise(0)).cast("double") / F.sum("n_events")
        ).alias("match_rate"),
    )
