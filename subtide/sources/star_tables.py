"""Subscription sources derived from order, customer and event tables.

The mapping is described in FIXTURES.md. It makes the three sources, as they
would arrive, from tables of any size: add-on sales from orders, licenses and
trials from the sales of a customer and product, product events from events.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.params import ReportParams
from subtide.sources.schemas import EVENT_FIELDS, EVENTS, LICENSE_FIELDS, LICENSES, TRANSACTION_FIELDS, TRANSACTIONS

PREFIX = "com.acme."
#: Puts the last order on the day before the report date.
DAYS_AHEAD = 8247
#: The cohort window runs from the first order to the last month that a payment covers.
PARAMS = ReportParams(
    as_of=date(2024, 3, 1), product_prefix=PREFIX, cohort_start=date(2017, 7, 1), cohort_periods=92
)
LOADED_AT = datetime(2024, 3, 1)


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: Column, *choices: str | None) -> Column:
    return F.element_at(F.array(*(F.lit(choice) for choice in choices)), (number % len(choices) + 1).cast("int"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as add-on sales."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("product_no"),
        F.date_add(F.col("o_orderdate").cast("date"), DAYS_AHEAD).alias("sale_date"),
        F.col("o_totalprice").alias("amount"),
    )


def sale_groups(sold: DataFrame) -> DataFrame:
    """First and last sale of each customer and product, combined before the shuffle."""
    return (
        sold.groupBy("customer_id", "product_no")
        .agg(
            F.min(F.struct("sale_date", "order_id")).alias("first"),
            F.max("sale_date").alias("last_date"),
        )
        .select(
            "customer_id",
            "product_no",
            F.col("first.sale_date").alias("first_date"),
            F.col("first.order_id").alias("first_order_id"),
            "last_date",
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions with unique ids."""
    sold = sales(spark, sf_dir)
    firsts = sale_groups(sold).select(F.col("first_order_id").alias("order_id"), F.lit(True).alias("is_first"))
    rows = sold.join(firsts, "order_id", "left")
    order_id, customer, product = F.col("order_id"), F.col("customer_id"), F.col("product_no")
    sale_type = (
        F.when(F.col("is_first"), "New")
        .when(order_id % 13 == 0, "Refund")
        .when(order_id % 11 == 0, "Upgrade")
        .otherwise("Renewal")
    )
    price = (
        F.when(F.col("sale_type") == "Refund", -F.col("amount"))
        .when(order_id % 7 == 0, 0.0)
        .otherwise(F.col("amount"))
    )
    yearly = customer % 2 == 0
    return (
        rows.withColumn("sale_type", sale_type)
        .withColumn("purchase_price", price)
        .select(
            _text(order_id).alias("transaction_id"),
            (customer * 100 + product).alias("addon_license_id"),
            _text("L", customer * 100 + product).alias("license_id"),
            F.when(customer % 3 != 0, _text("E", customer)).alias("app_entitlement_number"),
            _text(PREFIX + "p", product).alias("addon_key"),
            _text("Product ", product).alias("addon_name"),
            _pick(customer, "cloud", "Server", " data center").alias("hosting"),
            "sale_date",
            "sale_type",
            "purchase_price",
            (F.col("purchase_price") * 0.75).alias("vendor_amount"),
            F.when(yearly, "Annual").otherwise("Monthly").alias("billing_period"),
            _text("Tier ", customer % 4).alias("tier"),
            F.col("sale_date").alias("maintenance_start_date"),
            F.add_months("sale_date", F.when(yearly, 12).otherwise(1)).alias("maintenance_end_date"),
            _pick(order_id, "direct", "partner").alias("sale_channel"),
            _text("Host ", product).alias("parent_product_name"),
            _pick(customer, "standard", "premium").alias("parent_product_edition"),
            F.when(order_id % 3 == 0, 5.0).alias("loyalty_discount"),
            F.when(order_id % 5 == 0, 2.5).alias("marketplace_promotion_discount"),
            F.lit(None).cast("double").alias("expert_discount"),
            F.date_add("sale_date", 1).cast("timestamp").alias("extracted_at"),
            F.lit(LOADED_AT).cast("timestamp").alias("loaded_at"),
        )
    )


def company_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company name and place per customer."""
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    places = nations.select("n_nationkey", "n_name", "r_name")
    return _table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
    )


def company_id(customer: Column) -> Column:
    """Every tenth customer is a second workspace of the customer before it."""
    return customer - F.when(customer % 10 == 9, 1).otherwise(0)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw licenses with unique ids: one commercial license and up to two trials
    per customer and product."""
    customer, product = F.col("customer_id"), F.col("product_no")
    base = customer * 100 + product
    converted = (customer + product) % 3 == 0
    kinds = F.array(
        F.lit("commercial"),
        F.when(converted, F.lit("converted")),
        F.when((customer + product) % 4 == 1, F.lit("other")),
    )
    rows = (
        sale_groups(sales(spark, sf_dir))
        .withColumn("company_id", company_id(customer))
        .join(company_directory(spark, sf_dir), "company_id", "left")
        .withColumn("kind", F.explode(F.array_compact(kinds)))
        .withColumn("id", base + F.when(F.col("kind") == "converted", 10).when(F.col("kind") == "other", 20).otherwise(0))
    )
    commercial = F.col("kind") == "commercial"
    from_trial = commercial & converted
    trial_start = F.date_sub("first_date", 30)
    ends = (
        F.when(commercial, F.add_months("last_date", 12))
        .when(F.col("kind") == "converted", F.col("first_date"))
        .otherwise(F.date_add("first_date", 60))
    )
    suffix = _pick(customer, " GmbH", ", Inc.", "")
    has_cloud = customer % 4 != 0
    return rows.select(
        F.col("id").alias("addon_license_id"),
        _text("L", F.col("id")).alias("license_id"),
        F.when(customer % 3 != 0, _text("E", customer)).alias("app_entitlement_number"),
        _text(customer).alias("host_license_id"),
        F.when(customer % 5 != 0, _text("HE", customer)).alias("host_entitlement_number"),
        F.when(has_cloud, _text("c-", customer)).alias("cloud_id"),
        F.when(has_cloud, _text("site", customer, ".example.net")).alias("cloud_site_hostname"),
        _text(PREFIX + "p", product).alias("addon_key"),
        _text("Product ", product).alias("addon_name"),
        _pick(customer, "cloud", "Server", " data center").alias("hosting"),
        F.date_add("last_date", 1).cast("timestamp").alias("last_updated"),
        F.when(commercial, "Commercial").otherwise("EVALUATION").alias("license_type"),
        F.when(commercial, F.col("first_date")).otherwise(trial_start).alias("maintenance_start_date"),
        ends.alias("maintenance_end_date"),
        _pick(F.col("id"), "active", "Active", " ACTIVE", "ACTV", "expired ", "Cancelled").alias("status"),
        _text("Tier ", customer % 4).alias("tier"),
        F.concat("company_name", suffix).alias("company"),
        "country",
        "region",
        _text("admin", customer, "@example.com").alias("tech_contact_email"),
        _text("Admin ", customer).alias("tech_contact_name"),
        F.when(~commercial, "10-50").alias("evaluation_opportunity_size"),
        F.when(from_trial, base + 10).alias("evaluation_license"),
        F.when(from_trial, (customer % 30).cast("double")).alias("days_to_convert_eval"),
        F.when(from_trial, trial_start).alias("evaluation_start_date"),
        F.when(from_trial, F.col("first_date")).alias("evaluation_end_date"),
        F.when(from_trial, F.col("first_date")).alias("evaluation_sale_date"),
        F.date_add("last_date", 2).cast("timestamp").alias("extracted_at"),
        F.lit(LOADED_AT).cast("timestamp").alias("loaded_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product events with unique ids."""
    number, user = F.col("event_no"), F.col("user_no")
    rows = (
        _table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("event_no"),
            F.col("user_id").alias("user_no"),
            F.col("ts").cast("timestamp").alias("event_time"),
            "event_type",
            "props",
        )
        .withColumn("company_id", company_id(user))
        .join(company_directory(spark, sf_dir), "company_id", "left")
    )
    company = (
        F.when(number % 10 == 0, F.lit(None))
        .when(number % 17 == 0, _text("Unknown Org ", number % 100))
        .when(number % 2 == 0, F.concat("company_name", F.lit(" Ltd")))
        .otherwise(F.col("company_name"))
    )
    next_day = F.date_add(F.col("event_time").cast("date"), 1).cast("timestamp")
    return rows.select(
        _text(number).alias("event_id"),
        F.when(number % 300 == 1, "automated_test_run").otherwise(F.col("event_type")).alias("event_type"),
        "event_time",
        F.when(number % 12 != 0, _text("u", user)).alias("user_id"),
        F.when(number % 250 == 0, "bot-automation-001").otherwise(_text("dev-", user)).alias("device_id"),
        _pick(number, "Web", "iOS", "Android").alias("platform"),
        _pick(number, "client", "server").alias("event_source"),
        _text("P", number % 5 + 1).alias("product"),
        F.parse_json("props").alias("event_properties"),
        company.alias("user_property_company"),
        _pick(number, "", " None ", None, "pro").alias("user_property_plan"),
        _pick(number, "  ", "None", "gold").alias("user_property_tier"),
        (user * 100 + F.dayofmonth("event_time")).cast("bigint").alias("session_id"),
        F.upper("country").alias("country"),
        "region",
        next_day.alias("extracted_at"),
        (next_day + timedelta(hours=1)).alias("loaded_at"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country list; one nation in five is unknown to it."""
    known = _table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0")
    return known.select(F.col("n_name").alias("country_name"), _text("N", F.col("n_nationkey")).alias("iso_code"))


def redelivered(rows: DataFrame, table: str) -> DataFrame:
    """The rows with second copies mixed in, as deliveries contain them.

    Transactions and events repeat exactly; a repeated license is an older
    state of it.
    """
    again = {
        TRANSACTIONS: F.col("transaction_id").cast("bigint") % 100 == 3,
        EVENTS: F.col("event_id").cast("bigint") % 500 == 0,
        LICENSES: F.col("addon_license_id") % 37 == 0,
    }[table]
    copies = F.when(again, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    sent = rows.withColumn("_copy", F.explode(copies))
    if table == LICENSES:
        older = F.col("last_updated") - timedelta(days=10)
        sent = sent.withColumns(
            {
                "last_updated": F.when(F.col("_copy"), older).otherwise(F.col("last_updated")),
                "status": F.when(F.col("_copy"), "cancelled").otherwise(F.col("status")),
            }
        )
    return sent.drop("_copy")


RAW = {LICENSES: licenses, TRANSACTIONS: transactions, EVENTS: events}
PAYLOADS = {LICENSES: LICENSE_FIELDS, TRANSACTIONS: TRANSACTION_FIELDS, EVENTS: EVENT_FIELDS}


def envelopes(rows: DataFrame, table: str) -> DataFrame:
    """Rows as the JSON lines a source would deliver (``value``)."""
    payload = F.struct(
        *PAYLOADS[table], F.lit("spring").alias("campaign_name"), F.lit(0).alias("manual_discount")
    )
    envelope = F.struct(F.struct("extracted_at").alias("metadata"), payload.alias("payload"))
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return rows.select(F.to_json(envelope, exact).alias("value"), "loaded_at")


def broken_lines(rows: DataFrame) -> DataFrame:
    """Cut-off lines among the transactions of a delivery."""
    cut = rows.where(F.col("transaction_id").cast("bigint") % 50 == 7)
    return cut.select(_text('{"payload":{"transaction_id":"', F.col("transaction_id")).alias("value"))


def deliver(lines: DataFrame, folder: str) -> str:
    """Append JSON lines to a delivery folder as gzip files."""
    lines.select("value").write.mode("append").option("compression", "gzip").text(folder)
    return folder
