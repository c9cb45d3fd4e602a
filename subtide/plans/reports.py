"""Business reports over the marts, and the findings behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.dates import month_floor, shift_months
from subtide.functions.revenue import ratio
from subtide.functions.text import product_name
from subtide.operators.latest import top_k_per_group
from subtide.params import ReportParams


def active_customers_report(active: DataFrame, params: ReportParams) -> DataFrame:
    """Active workspaces per product and completed month."""
    months = active.where(F.col("sale_month") < F.lit(month_floor(params.as_of)))
    return months.select(
        "sale_month",
        "addon_key",
        product_name(F.col("addon_key"), params.product_prefix).alias("product"),
        F.col("active_workspaces_per_product_month").alias("active_customers"),
    ).distinct()


def trial_conversion_report(conversion: DataFrame, params: ReportParams) -> DataFrame:
    """Conversion per product, over cohorts with at least one resolved trial."""
    resolved = conversion.where(F.col("converted_count") + F.col("expired_count") > 0)
    return (
        resolved.groupBy("addon_key")
        .agg(
            F.sum("total_trials").alias("total_trials"),
            F.sum("converted_count").alias("converted"),
            F.round(F.avg("avg_days_to_convert"), 1).alias("avg_days_to_convert"),
        )
        .select(
            product_name(F.col("addon_key"), params.product_prefix).alias("product"),
            "total_trials",
            "converted",
            F.round(ratio(F.col("converted"), F.col("total_trials")) * 100, 1).alias("conversion_rate_pct"),
            "avg_days_to_convert",
        )
    )


def nrr_churn_report(churn: DataFrame, params: ReportParams, months: int = 6) -> DataFrame:
    """Net revenue retention and logo churn of monthly plans, last completed months."""
    this_month = month_floor(params.as_of)
    window = churn.where(
        (F.col("billing_period") == "Monthly")
        & (F.col("sale_month") >= F.lit(shift_months(this_month, -months)))
        & (F.col("sale_month") < F.lit(this_month))
    )
    retained = F.col("renewal_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr")
    churned = 1 - ratio(F.sum("renewing_logos"), F.sum("beginning_logos"))
    return window.groupBy("sale_month").agg(
        F.round(F.sum("total_mrr"), 2).alias("total_mrr"),
        F.round(ratio(F.sum(retained), F.sum("beginning_mrr")) * 100, 1).alias("nrr_pct"),
        F.round(churned * 100, 1).alias("logo_churn_pct"),
        F.sum("new_logos").alias("new_logos"),
        F.sum("total_logos").alias("total_logos"),
    )


def feature_signal_report(adoption: DataFrame, params: ReportParams, k: int = 3) -> DataFrame:
    """Features per product that converted trials use most, against expired ones.

    A feature that no expired trial used has no ratio and ranks first.
    """
    def average(cohort):
        return F.max(F.when(F.col("customer_cohort") == cohort, F.col("avg_events_per_workspace")))

    compared = (
        adoption.where(F.col("customer_cohort").isin("converted", "expired"))
        .groupBy(product_name(F.col("product"), params.product_prefix).alias("product"), "event_type")
        .agg(
            F.round(average("converted"), 1).alias("converted"),
            F.round(average("expired"), 1).alias("expired"),
            F.round(ratio(average("converted"), average("expired")), 1).alias("conversion_signal_ratio"),
        )
        .where(F.col("converted").isNotNull())
    )
    order = [F.col("conversion_signal_ratio").desc_nulls_first(), F.col("event_type").asc_nulls_last()]
    return top_k_per_group(compared, ["product"], order, k)


def multi_product_share(hub: DataFrame) -> DataFrame:
    """Workspaces, and those with more than one product."""
    many = F.count_if(F.col("product_count") > 1)
    return hub.agg(
        F.count(F.lit(1)).alias("workspaces"),
        many.alias("multi_product_workspaces"),
        ratio(many, F.count(F.lit(1))).alias("multi_product_share"),
    )


def users_per_license(keyed: DataFrame, licenses: DataFrame, params: ReportParams) -> DataFrame:
    """Customers, active licenses and average monthly users per product."""
    per_workspace = licenses.groupBy(
        product_name(F.col("addon_key"), params.product_prefix).alias("product"), "host_license_id"
    ).agg(F.max("is_active").alias("is_active"))
    owned = per_workspace.groupBy("product").agg(
        F.count("host_license_id").alias("customers"),
        F.count_if(F.col("is_active") & F.col("host_license_id").isNotNull()).alias("active_licenses"),
    )
    monthly = (
        keyed.groupBy("product", "event_month")
        .agg(F.count_distinct("user_id").alias("users"))
        .groupBy("product")
        .agg(F.avg("users").alias("avg_monthly_users"))
    )
    return owned.join(monthly, "product", "left").withColumn(
        "users_per_active_license", ratio(F.col("avg_monthly_users"), F.col("active_licenses"))
    )


def zero_value_trials(lifecycle: DataFrame) -> DataFrame:
    """Resolved trials, conversions, and conversions without any revenue."""
    resolved = F.count_if(F.col("is_converted") | F.col("is_expired_no_convert"))
    converted = F.count_if("is_converted")
    free = F.count_if(F.col("is_converted") & (F.col("converted_arr") == 0))
    return lifecycle.agg(
        resolved.alias("resolved_trials"),
        converted.alias("converted_trials"),
        free.alias("zero_value_converted"),
        ratio(converted, resolved).alias("conversion_rate"),
        ratio(converted - free, resolved).alias("paid_conversion_rate"),
    )


def zero_value_customers(mrr: DataFrame) -> DataFrame:
    """Workspaces whose NEW sales were all free of charge."""
    per_workspace = (
        mrr.where((F.col("sale_type") == "NEW") & F.col("instance_id").isNotNull())
        .groupBy("instance_id")
        .agg(F.min("is_zero_value").alias("only_zero"))
    )
    return per_workspace.agg(
        F.count(F.lit(1)).alias("workspaces"),
        F.count_if("only_zero").alias("zero_value_workspaces"),
        ratio(F.count_if("only_zero"), F.count(F.lit(1))).alias("zero_value_share"),
    )


def feature_depth(usage: DataFrame) -> DataFrame:
    """Engaged workspaces per product by number of distinct features used."""
    depth = (
        usage.where("is_matched")
        .groupBy("product", "instance_id")
        .agg(F.count_distinct("event_type").alias("features"))
    )
    bucket = F.when(F.col("features") >= 10, "10+").when(F.col("features") >= 5, "5-9").otherwise("1-4")
    return depth.groupBy("product", bucket.alias("features_used")).agg(F.count(F.lit(1)).alias("workspaces"))
