"""Revenue rows, trials and annual cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subtide.functions.dates import month_after, month_of
from subtide.functions.revenue import is_renewal_gap, monthly_amount
from subtide.operators.lookups import left_join_split
from subtide.operators.previous import previous_row
from subtide.operators.spread import month_spread
from subtide.params import ReportParams

SALE_ORDER = ["sale_date", "transaction_id"]

#: Holds every amount that a DOUBLE can tell to the cent.
MONEY = "decimal(28,6)"


def revenue_rows(transactions: DataFrame) -> DataFrame:
    """New and renewed sales that are not refunds; an unknown price drops out."""
    return transactions.where(F.col("sale_type").isin("NEW", "RENEWAL") & ~F.col("is_refund"))


def monthly_mrr(transactions: DataFrame, licenses: DataFrame) -> DataFrame:
    """One row per revenue transaction with its monthly amount and renewal gap."""
    owners = licenses.select("addon_license_id", "cloud_id", "host_license_id", "company", "country")
    owned = (
        revenue_rows(transactions)
        .join(owners, "addon_license_id", "left")
        .withColumns(
            {
                "instance_id": F.col("host_license_id"),
                "sale_month": month_of(F.col("sale_date")),
                "mrr": monthly_amount(F.col("purchase_price"), F.col("billing_period")),
                "expected_next_renewal_month": month_after(F.col("maintenance_end_date")),
            }
        )
    )
    dated = previous_row(
        owned, ["instance_id", "addon_key"], SALE_ORDER, {"prev_renewal_month": "sale_month"}
    )
    gap = is_renewal_gap(
        F.col("sale_type"), F.col("billing_period"), F.col("prev_renewal_month"), F.col("sale_month")
    )
    return dated.select(
        "transaction_id",
        "addon_license_id",
        "instance_id",
        "cloud_id",
        "host_license_id",
        "addon_key",
        "addon_name",
        "hosting",
        "company",
        "country",
        "sale_date",
        "sale_month",
        "sale_type",
        "billing_period",
        "purchase_price",
        "vendor_amount",
        "mrr",
        "tier",
        "maintenance_start_date",
        "maintenance_end_date",
        "sale_channel",
        "is_zero_value",
        "is_refund",
        "prev_renewal_month",
        "expected_next_renewal_month",
        gap.alias("is_renewal_gap"),
    )


def first_sale(transactions: DataFrame) -> DataFrame:
    """First NEW sale and NEW revenue per license."""
    new_sales = transactions.where((F.col("sale_type") == "NEW") & ~F.col("is_refund"))
    return new_sales.groupBy("addon_license_id").agg(
        F.min("sale_date").alias("first_sale_date"), F.sum("purchase_price").alias("total_arr")
    )


def trial_conversions(licenses: DataFrame, transactions: DataFrame) -> DataFrame:
    """Licenses that came from a trial, with their first sale.

    Sales are joined to the conversions first: the trials that never converted
    have no license to look up, and as NULL keys they would share one task.
    """
    return (
        licenses.where("is_converted")
        .select(
            F.col("evaluation_license").alias("eval_license_id"),
            F.col("addon_license_id").alias("commercial_license_id"),
            F.col("maintenance_start_date").alias("commercial_start_date"),
            F.col("tier").alias("commercial_tier"),
            "days_to_convert_eval",
        )
        .join(
            first_sale(transactions).withColumnRenamed("addon_license_id", "commercial_license_id"),
            "commercial_license_id",
            "left",
        )
    )


def trial_lifecycle(
    licenses: DataFrame, transactions: DataFrame, params: ReportParams, conversions: DataFrame | None = None
) -> DataFrame:
    """One row per trial and conversion.

    ``conversions`` may be ``trial_conversions`` written in buckets of
    ``eval_license_id``, as the licenses are in those of their own id; the join
    then needs no exchange.
    """
    trials = licenses.where("is_evaluation").select(
        F.col("addon_license_id").alias("eval_license_id"),
        "addon_key",
        F.col("host_license_id").alias("instance_id"),
        "company",
        "country",
        "hosting",
        F.col("tier").alias("eval_tier"),
        F.col("maintenance_start_date").alias("eval_start_date"),
        F.col("maintenance_end_date").alias("eval_end_date"),
    )
    converted = F.col("commercial_license_id").isNotNull()
    over = F.col("eval_end_date") < F.lit(params.as_of)
    if conversions is None:
        # Nothing keeps several licenses from naming one trial.
        found = trial_conversions(licenses, transactions)
        joined = left_join_split(trials, found, "eval_license_id", spread_by="instance_id")
    else:
        joined = trials.join(conversions.where("eval_license_id IS NOT NULL"), "eval_license_id", "left")
    return joined.select(
        *trials.columns,
        "commercial_license_id",
        "commercial_start_date",
        "commercial_tier",
        "days_to_convert_eval",
        "first_sale_date",
        F.col("total_arr").alias("converted_arr"),
        F.when(converted, "converted").when(over, "expired").otherwise("active_trial").alias("trial_outcome"),
        converted.alias("is_converted"),
        (over & ~converted).alias("is_expired_no_convert"),
        month_of(F.col("eval_start_date")).alias("eval_cohort_month"),
    )


def annual_revenue(transactions: DataFrame, licenses: DataFrame) -> DataFrame:
    """Annual-plan revenue per workspace, add-on and month, with the cohort.

    The cohort is the month of the first NEW sale; revenue of pairs that never
    had one is left out. Amounts are exact decimals, because half cents are
    common after division by twelve and a rounded sum must not depend on the
    order of its rows.
    """
    owners = licenses.where(F.col("host_license_id").isNotNull()).select(
        "addon_license_id", F.col("host_license_id").alias("instance_id")
    )
    monthly = (
        revenue_rows(transactions)
        .where(F.upper("billing_period") == "ANNUAL")
        .join(owners, "addon_license_id")
        .groupBy("instance_id", "addon_key", month_of(F.col("sale_date")).alias("txn_month"))
        .agg(
            F.sum(F.col("purchase_price").cast(MONEY)).alias("amount"),
            F.max(F.col("sale_type") == "NEW").alias("has_new"),
        )
    )
    # At most one row per calendar month is left for a workspace and add-on.
    pair = Window.partitionBy("instance_id", "addon_key")
    cohort = F.min(F.when(F.col("has_new"), F.col("txn_month"))).over(pair)
    return monthly.withColumn("cohort_month", cohort).where(F.col("cohort_month").isNotNull())


def acquisitions(transactions: DataFrame, licenses: DataFrame) -> DataFrame:
    """Month of the first annual NEW sale per workspace and add-on."""
    revenue = annual_revenue(transactions, licenses)
    return revenue.where(F.col("txn_month") == F.col("cohort_month")).select(
        "instance_id", "addon_key", "cohort_month"
    )


def cohort_spread(transactions: DataFrame, licenses: DataFrame, params: ReportParams) -> DataFrame:
    """Annual revenue per cohort, spread over the months it covers.

    Sums are linear, so revenue is added up per cohort and sale month before
    it is spread; the spread then works on months, not on payments.
    """
    by_sale_month = (
        annual_revenue(transactions, licenses)
        .groupBy("cohort_month", "addon_key", "txn_month")
        .agg(
            F.sum("amount").alias("amount"),
            F.count(F.when(F.col("txn_month") == F.col("cohort_month"), 1)).alias("new_instances"),
        )
    )
    spread = month_spread(
        by_sale_month, "cohort_month", "txn_month", "revenue_month", periods=params.cohort_periods
    )
    # An acquisition is counted in the first of its months only.
    return spread.withColumn(
        "new_instances",
        F.when(F.col("revenue_month") == F.col("cohort_month"), F.col("new_instances")).otherwise(0),
    )


def annual_cohort_matrix(transactions: DataFrame, licenses: DataFrame, params: ReportParams) -> DataFrame:
    """Cohorts as rows, calendar months as columns.

    Amounts are added up per cohort and month first. A cohort then has at most
    one entry per month, which a map holds, and each column looks its month up.
    """
    by_month = (
        cohort_spread(transactions, licenses, params)
        .groupBy("cohort_month", "addon_key", "revenue_month")
        .agg(F.sum("amount").alias("amount"), F.sum("new_instances").alias("new_instances"))
    )
    entries = F.collect_list(F.struct("revenue_month", "amount"))
    cohorts = by_month.groupBy("cohort_month", "addon_key").agg(
        F.sum("new_instances").alias("cohort_size"), F.map_from_entries(entries).alias("amounts")
    )
    cells = [
        f"CAST(round(amounts[DATE '{month}'] / 12BD, 2) AS DOUBLE) AS m_{month:%Y_%m}" for month in params.cohort_months()
    ]
    return cohorts.selectExpr("cohort_month", "addon_key", "cohort_size", *cells)
