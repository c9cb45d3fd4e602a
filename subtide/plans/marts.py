"""The five marts. Rows come unordered; ``presented`` adds the reading order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subtide.functions import health
from subtide.functions.dates import month_floor
from subtide.functions.revenue import movement, ratio
from subtide.functions.text import product_name
from subtide.operators.median import grouped_middle, positive_median
from subtide.operators.previous import previous_row
from subtide.operators.rollups import distinct_over, rows_over
from subtide.params import ReportParams
from subtide.plans.subscriptions import SALE_ORDER
from subtide.session import materialized

CHURN_GRAIN = ["sale_month", "addon_key", "addon_name", "billing_period"]
ADOPTION_GRAIN = ["event_month", "product", "event_type", "customer_cohort"]


def active_customers(mrr: DataFrame) -> DataFrame:
    """Workspaces with a new or renewed sale, per product and month.

    The activity is needed three times (rows and two totals), so it is written
    once; the totals read only their key columns of it.
    """
    activity = (
        mrr.where(
            F.col("sale_type").isin("NEW", "RENEWAL")
            & ~F.col("is_refund")
            & F.col("instance_id").isNotNull()
        )
        .groupBy("sale_month", "addon_key", "addon_name", "hosting", "instance_id", "company", "country")
        .agg(
            F.sum("mrr").alias("monthly_mrr"),
            F.count("transaction_id").alias("transaction_count"),
            F.max("is_zero_value").alias("has_zero_value_tx"),
        )
    )
    activity = materialized(activity, "activity")
    per_product = rows_over(activity, ["sale_month", "addon_key"], "active_workspaces_per_product_month")
    return distinct_over(per_product, ["sale_month"], "instance_id", "total_active_workspaces_month")


def trial_conversion(lifecycle: DataFrame, params: ReportParams) -> DataFrame:
    """Trials by start month and product, with conversion rate and time."""
    outcome = F.col("trial_outcome")
    # As coded, the mart looks for a label that the trial model never gives.
    expired = outcome == "expired_no_convert" if params.literal else F.col("is_expired_no_convert")
    converted = F.col("is_converted")
    grain = ["eval_cohort_month", "addon_key"]
    # Rows shrink to one per group and number of days, of which there are few.
    per_days = (
        lifecycle.withColumn("days", F.when(converted, F.col("days_to_convert_eval")))
        .groupBy(*grain, "days")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(outcome == "converted").alias("converted_count"),
            F.count_if(expired).alias("expired_count"),
            F.count_if(outcome == "active_trial").alias("active_trial_count"),
            F.sum(F.when(converted, F.col("converted_arr")).otherwise(0.0)).alias("arr"),
        )
    )
    marked = per_days.withColumn("in_middle", grouped_middle(grain, "days", F.col("n")))
    known = F.when(F.col("days").isNotNull(), F.col("n"))
    counted = marked.groupBy(*grain).agg(
        F.sum("n").alias("total_trials"),
        *(F.sum(name).alias(name) for name in ("converted_count", "expired_count", "active_trial_count")),
        (F.sum(F.col("days") * F.col("n")) / F.sum(known)).alias("avg_days_to_convert"),
        F.avg(F.when(F.col("in_middle"), F.col("days"))).alias("median_days_to_convert"),
        F.sum("arr").alias("cohort_converted_arr"),
    )
    resolved = F.col("converted_count") + F.col("expired_count")
    return counted.withColumn("conversion_rate", F.round(ratio(F.col("converted_count"), resolved), 4))


def prior_amounts(mrr: DataFrame) -> DataFrame:
    """Revenue rows with the amount of the workspace's previous one."""
    rows = mrr.where(~F.col("is_refund") & F.col("instance_id").isNotNull())
    return previous_row(rows, ["instance_id", "addon_key", "billing_period"], SALE_ORDER, {"prior_mrr": "mrr"})


def movements(mrr: DataFrame) -> DataFrame:
    """Revenue rows with their class of movement."""
    kind = movement(F.col("sale_type"), F.col("is_renewal_gap"), F.col("mrr"), F.col("prior_mrr"))
    return prior_amounts(mrr).withColumn("mrr_movement_type", kind)


def mrr_churn(mrr: DataFrame) -> DataFrame:
    """Movements, net revenue retention and logo churn per month and product.

    Rows are reduced to workspaces before they are counted, which replaces
    four distinct counts by plain sums.
    """
    kind = F.col("mrr_movement_type")
    kinds = ("new", "renewal", "expansion", "contraction", "reactivation")
    per_workspace = (
        movements(mrr)
        .groupBy(*CHURN_GRAIN, "instance_id")
        .agg(
            *(F.sum(F.when(kind == name, F.col("mrr")).otherwise(0.0)).alias(f"{name}_mrr") for name in kinds),
            F.sum("mrr").alias("total_mrr"),
            F.max(kind == "new").alias("is_new"),
            F.max(kind == "renewal").alias("is_renewing"),
            F.max("is_zero_value").alias("has_zero_value"),
        )
    )
    summary = per_workspace.groupBy(*CHURN_GRAIN).agg(
        *(F.sum(f"{name}_mrr").alias(f"{name}_mrr") for name in (*kinds, "total")),
        F.count_if("is_new").alias("new_logos"),
        F.count_if("is_renewing").alias("renewing_logos"),
        F.count(F.lit(1)).alias("total_logos"),
        F.count_if("has_zero_value").alias("zero_value_logos"),
    )
    # One row per month and product is left, so this window stays small.
    earlier = Window.partitionBy("addon_key", "billing_period").orderBy("sale_month", "addon_name")
    retained = F.col("renewal_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr")
    return (
        summary.withColumns(
            {
                "beginning_mrr": F.lag("total_mrr").over(earlier),
                "beginning_logos": F.lag("total_logos").over(earlier),
            }
        )
        .withColumns(
            {
                "nrr": F.round(ratio(retained, F.col("beginning_mrr")), 4),
                "logo_churn_rate": F.round(1.0 - ratio(F.col("renewing_logos"), F.col("beginning_logos")), 4),
            }
        )
    )


def usage_by_trial(usage: DataFrame, lifecycle: DataFrame, params: ReportParams) -> DataFrame:
    """Usage rows with the outcome of the workspace's trials of that product.

    A workspace with several trials repeats its usage once per trial. The
    repeats are carried as a weight (``n_trials``), so the join yields at most
    one row per usage row and outcome.
    """
    trials = (
        lifecycle.where(F.col("instance_id").isNotNull())
        .groupBy(
            "instance_id",
            product_name(F.col("addon_key"), params.product_prefix).alias("product"),
            "trial_outcome",
        )
        .agg(F.count(F.lit(1)).alias("n_trials"))
    )
    return (
        usage.where(F.col("instance_id").isNotNull())
        .join(trials, ["instance_id", "product"], "left")
        .withColumns(
            {
                "customer_cohort": F.coalesce("trial_outcome", F.lit("non_trial")),
                "n_trials": F.coalesce("n_trials", F.lit(1)),
            }
        )
        .drop("trial_outcome")
    )


def feature_adoption(usage: DataFrame, lifecycle: DataFrame, params: ReportParams) -> DataFrame:
    """Usage per feature and trial outcome."""
    weight = F.col("n_trials")
    per_workspace = (
        usage_by_trial(usage, lifecycle, params)
        .groupBy(*ADOPTION_GRAIN, "instance_id")
        .agg(
            F.sum(F.col("event_count") * weight).alias("events"),
            F.sum(F.col("unique_users") * weight).alias("users"),
            F.sum(F.col("unique_sessions") * weight).alias("sessions"),
            F.sum(weight).alias("n_rows"),
            F.max(F.col("event_count") > 0).alias("used"),
        )
    )
    return (
        per_workspace.groupBy(*ADOPTION_GRAIN)
        .agg(
            F.count(F.lit(1)).alias("workspace_count"),
            F.sum("events").alias("total_events"),
            F.sum("users").alias("total_unique_users"),
            F.sum("sessions").alias("total_unique_sessions"),
            F.sum("n_rows").alias("n_rows"),
            F.count_if("used").alias("n_used"),
        )
        .select(
            *ADOPTION_GRAIN,
            "workspace_count",
            "total_events",
            "total_unique_users",
            "total_unique_sessions",
            ratio(F.col("total_events"), F.col("n_rows")).alias("avg_events_per_workspace"),
            ratio(F.col("total_unique_users"), F.col("n_rows")).alias("avg_users_per_workspace"),
            ratio(F.col("n_used"), F.col("workspace_count")).alias("feature_adoption_rate"),
        )
    )


def license_signal(licenses: DataFrame, params: ReportParams) -> DataFrame:
    grain = [F.col("host_license_id").alias("instance_id"), "company", "country"]
    return (
        licenses.groupBy(*grain)
        .agg(
            F.max("is_active").alias("has_active_license"),
            F.count_distinct("addon_key").alias("product_count"),
            F.max("maintenance_end_date").alias("latest_maintenance_end"),
        )
        .withColumn(
            "days_since_maintenance_end", F.datediff(F.lit(params.as_of), F.col("latest_maintenance_end"))
        )
    )


def revenue_signal(mrr: DataFrame) -> DataFrame:
    """Revenue per workspace in the last month with any revenue row."""
    last_month = mrr.agg(F.max("sale_month").alias("sale_month"))
    return (
        mrr.where(
            (F.col("sale_month") == last_month.scalar())
            & ~F.col("is_refund")
            & F.col("instance_id").isNotNull()
        )
        .groupBy("instance_id")
        .agg(F.sum("mrr").alias("current_mrr"), F.max("sale_month").alias("last_transaction_month"))
    )


def engagement_signal(usage: DataFrame, params: ReportParams) -> DataFrame:
    since = month_floor(params.as_of - timedelta(days=params.engagement_days))
    recent = usage.where(
        (F.col("event_month") >= F.lit(since)) & F.col("is_matched") & F.col("instance_id").isNotNull()
    )
    return recent.groupBy("instance_id").agg(
        F.sum("event_count").alias("events_90d"),
        F.count_distinct("event_type").alias("distinct_features_90d"),
        F.sum("unique_users").alias("unique_users_90d"),
        F.max("event_month").alias("last_active_month"),
    )


def customer_health(licenses: DataFrame, mrr: DataFrame, usage: DataFrame, params: ReportParams) -> DataFrame:
    """Score per workspace from its licenses, revenue and usage.

    The revenue of the last month feeds both the median and the scores, so it
    is written once.
    """
    revenue = materialized(revenue_signal(mrr), "revenue")
    median = positive_median(revenue, "current_mrr", "med_mrr").scalar()
    joined = (
        license_signal(licenses, params)
        .join(revenue, "instance_id", "left")
        .join(engagement_signal(usage, params), "instance_id", "left")
    )
    scored = joined.withColumns(
        {
            "license_score": health.license_score(
                F.col("has_active_license"), F.col("days_since_maintenance_end")
            ),
            "revenue_score": health.revenue_score(F.col("current_mrr"), median),
            "engagement_score": health.engagement_score(F.col("distinct_features_90d")),
        }
    )
    score = health.health_score(F.col("license_score"), F.col("revenue_score"), F.col("engagement_score"))
    counts = ("events_90d", "distinct_features_90d", "unique_users_90d")
    return (
        scored.withColumns(
            {
                "current_mrr": F.coalesce("current_mrr", F.lit(0.0)),
                **{name: F.coalesce(name, F.lit(0)) for name in counts},
                "health_score": score,
            }
        )
        .withColumn("health_segment", health.health_segment(F.col("health_score")))
        .select(
            "instance_id",
            "company",
            "country",
            "product_count",
            "has_active_license",
            "latest_maintenance_end",
            "days_since_maintenance_end",
            "current_mrr",
            "last_transaction_month",
            "events_90d",
            "distinct_features_90d",
            "unique_users_90d",
            "last_active_month",
            "license_score",
            "revenue_score",
            "engagement_score",
            "health_score",
            "health_segment",
        )
    )


# Reading order; a leading minus means newest or greatest first.
READING_ORDER = {
    "int_annual_mrr_cohort": ("cohort_month", "addon_key"),
    "mart_active_customers": ("-sale_month", "addon_key", "instance_id"),
    "mart_trial_conversion": ("-eval_cohort_month", "addon_key"),
    "mart_mrr_churn": ("-sale_month", "addon_key", "billing_period"),
    "mart_feature_adoption": ("-event_month", "product", "event_type", "customer_cohort"),
    "mart_customer_health": ("-health_score",),
    "report_active_customers": ("sale_month",),
    "report_nrr_churn": ("-sale_month",),
    "report_feature_signal": ("product", "-conversion_signal_ratio"),
}


def presented(df: DataFrame, table: str) -> DataFrame:
    """Sorted for reading; NULL counts as greatest."""
    order = [
        F.col(name[1:]).desc_nulls_first() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in READING_ORDER[table]
    ]
    return df.orderBy(*order)
