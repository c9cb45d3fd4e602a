"""Cleaning of the three sources: typed, one row per key, normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.text import compact_lower, is_active_status, license_status, missing_text
from subtide.operators.latest import latest_per_key
from subtide.sources.schemas import EVENTS, FIELDS, KEYS, LICENSES, TRANSACTIONS

# How automated traffic is recognised.
BOT_DEVICE = "bot-automation-001"
TEST_EVENT = "automated_test_run"

# Order that decides which copy of a key is kept; the greatest wins.
NEWEST = {
    LICENSES: ("last_updated", "extracted_at", "loaded_at"),
    TRANSACTIONS: ("extracted_at", "loaded_at"),
    EVENTS: ("event_time", "extracted_at", "loaded_at"),
}


def extract(landed: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Typed columns of the JSON envelope.

    Only the listed fields are read. A value that does not fit its type fails
    the job; with ``strict=False`` it becomes NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    fields = [
        get("raw_data", f"$.payload.{name}", kind).alias(name) for name, kind in FIELDS[table].items()
    ]
    extracted_at = get("raw_data", "$.metadata.extracted_at", "timestamp").alias("extracted_at")
    return landed.select(*fields, extracted_at, "loaded_at")


def deduplicate(typed: DataFrame, table: str) -> DataFrame:
    return latest_per_key(typed, [KEYS[table]], NEWEST[table])


def clean_licenses(typed: DataFrame) -> DataFrame:
    cleaned = typed.select(
        *FIELDS[LICENSES],
        (F.lower("license_type") == "evaluation").alias("is_evaluation"),
        is_active_status(F.col("status")).alias("is_active"),
        F.col("evaluation_license").isNotNull().alias("is_converted"),
        "extracted_at",
        "loaded_at",
    )
    return cleaned.withColumns(
        {
            "hosting": compact_lower(F.col("hosting")),
            "license_type": F.lower("license_type"),
            "status": license_status(F.col("status")),
        }
    )


def clean_transactions(typed: DataFrame) -> DataFrame:
    cleaned = typed.select(
        *FIELDS[TRANSACTIONS],
        (F.col("purchase_price") == 0).alias("is_zero_value"),
        (F.col("purchase_price") < 0).alias("is_refund"),
        "extracted_at",
        "loaded_at",
    )
    discounts = ("loyalty_discount", "marketplace_promotion_discount", "expert_discount")
    return cleaned.withColumns(
        {
            "hosting": compact_lower(F.col("hosting")),
            "sale_type": F.upper("sale_type"),
            **{name: F.coalesce(name, F.lit(0.0)) for name in discounts},
        }
    )


def clean_events(typed: DataFrame) -> DataFrame:
    cleaned = typed.select(
        *FIELDS[EVENTS],
        F.col("user_id").isNull().alias("is_anonymous"),
        (F.col("device_id") == BOT_DEVICE).alias("is_bot"),
        (F.col("event_type") == TEST_EVENT).alias("is_test_event"),
        "extracted_at",
        "loaded_at",
    )
    return cleaned.withColumns(
        {
            **{name: F.lower(name) for name in ("platform", "product", "country", "region")},
            **{name: missing_text(F.col(name)) for name in ("user_property_plan", "user_property_tier")},
        }
    )


CLEAN = {LICENSES: clean_licenses, TRANSACTIONS: clean_transactions, EVENTS: clean_events}


def stage(typed: DataFrame, table: str) -> DataFrame:
    """Deduplicate and clean typed rows."""
    return CLEAN[table](deduplicate(typed, table))


def stage_landed(landed: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Extract, deduplicate and clean landed rows."""
    return stage(extract(landed, table, strict), table)
