"""Payload fields of the three sources and the contracts of their tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LICENSES = "stg_marketplace_licenses"
TRANSACTIONS = "stg_marketplace_transactions"
EVENTS = "stg_amplitude_events"

# Field names and types of the payload, which callers rely on.
LICENSE_FIELDS = {
    "addon_license_id": "bigint",
    "license_id": "string",
    "app_entitlement_number": "string",
    "host_license_id": "string",
    "host_entitlement_number": "string",
    "cloud_id": "string",
    "cloud_site_hostname": "string",
    "addon_key": "string",
    "addon_name": "string",
    "hosting": "string",
    "last_updated": "timestamp",
    "license_type": "string",
    "maintenance_start_date": "date",
    "maintenance_end_date": "date",
    "status": "string",
    "tier": "string",
    "company": "string",
    "country": "string",
    "region": "string",
    "tech_contact_email": "string",
    "tech_contact_name": "string",
    "evaluation_opportunity_size": "string",
    "evaluation_license": "bigint",
    "days_to_convert_eval": "double",
    "evaluation_start_date": "date",
    "evaluation_end_date": "date",
    "evaluation_sale_date": "date",
}
TRANSACTION_FIELDS = {
    "transaction_id": "string",
    "addon_license_id": "bigint",
    "license_id": "string",
    "app_entitlement_number": "string",
    "addon_key": "string",
    "addon_name": "string",
    "hosting": "string",
    "sale_date": "date",
    "sale_type": "string",
    "purchase_price": "double",
    "vendor_amount": "double",
    "billing_period": "string",
    "tier": "string",
    "maintenance_start_date": "date",
    "maintenance_end_date": "date",
    "sale_channel": "string",
    "parent_product_name": "string",
    "parent_product_edition": "string",
    "loyalty_discount": "double",
    "marketplace_promotion_discount": "double",
    "expert_discount": "double",
}
EVENT_FIELDS = {
    "event_id": "string",
    "event_type": "string",
    "event_time": "timestamp",
    "user_id": "string",
    "device_id": "string",
    "platform": "string",
    "event_source": "string",
    "product": "string",
    "event_properties": "variant",
    "user_property_company": "string",
    "user_property_plan": "string",
    "user_property_tier": "string",
    "session_id": "bigint",
    "country": "string",
    "region": "string",
}
FIELDS = {LICENSES: LICENSE_FIELDS, TRANSACTIONS: TRANSACTION_FIELDS, EVENTS: EVENT_FIELDS}
KEYS = {LICENSES: "addon_license_id", TRANSACTIONS: "transaction_id", EVENTS: "event_id"}


@dataclass(frozen=True)
class Contract:
    """Checks of one table: required, unique, value lists and references."""

    table: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def size(self) -> int:
        return sum(map(len, (self.not_null, self.unique, self.accepted, self.references)))


# The checks of the three cleaned tables.
HOSTING = ("cloud", "server", "datacenter")
CONTRACTS = {
    LICENSES: Contract(
        table=LICENSES,
        not_null=(
            "addon_license_id", "license_id", "host_license_id", "addon_key", "addon_name",
            "hosting", "last_updated", "license_type", "maintenance_start_date",
            "maintenance_end_date", "status", "tier", "company", "country", "region",
            "tech_contact_email", "tech_contact_name", "extracted_at", "loaded_at",
        ),
        unique=("addon_license_id",),
        accepted=(
            ("hosting", HOSTING),
            ("license_type", ("evaluation", "commercial", "academic", "community")),
            ("status", ("active", "expired", "cancelled")),
        ),
    ),
    TRANSACTIONS: Contract(
        table=TRANSACTIONS,
        not_null=(
            "transaction_id", "addon_license_id", "license_id", "addon_key", "addon_name",
            "hosting", "sale_date", "sale_type", "purchase_price", "vendor_amount",
            "billing_period", "tier", "maintenance_start_date", "maintenance_end_date",
            "sale_channel", "parent_product_name", "parent_product_edition",
            "loyalty_discount", "marketplace_promotion_discount", "expert_discount",
            "extracted_at", "loaded_at",
        ),
        unique=("transaction_id",),
        accepted=(
            ("hosting", HOSTING),
            ("sale_type", ("NEW", "RENEWAL", "UPGRADE", "REFUND")),
        ),
        references=(("addon_license_id", LICENSES, "addon_license_id"),),
    ),
    EVENTS: Contract(
        table=EVENTS,
        not_null=(
            "event_id", "event_type", "event_time", "device_id", "platform", "event_source",
            "product", "session_id", "extracted_at", "loaded_at",
        ),
        unique=("event_id",),
    ),
}

# Landing rows: the parsed envelope, or the text of a line that is not JSON.
LANDING = T.StructType(
    [
        T.StructField("raw_data", T.VariantType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
