"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "acquisitions", "annual_cohort_matrix", "company_bridge", "customers", "engagement_signal", "feature_adoption",
    "feature_usage", "fk_violations", "median_mrr", "monthly_mrr", "mrr_churn", "profile", "report_feature_signal",
    "report_nrr_churn", "revenue_signal", "trial_conversion", "trial_lifecycle", "usage_by_trial",
]


def plan(spark, name):
    return registered.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text, operator


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "acquisitions")
    assert "o_orderstatus" not in text and "c_acctbal" not in text
    text = plan(spark, "layer_acquisitions")
    assert "IsNotNull(host_license_id)" in text and "In(sale_type, [NEW,RENEWAL])" in text
    assert "vendor_amount" not in text


def below(text, operator):
    """Lines of the plan below each line that holds ``operator``."""
    lines = text.split("== Initial Plan ==")[-1].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*|")) for line in lines]
    for n, line in enumerate(lines):
        if operator in line:
            end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            yield "\n".join(lines[n + 1 : end])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name, join, n_joins",
    [
        ("layer_monthly_mrr", "Join [addon_license_id", 1),
        ("layer_trial_lifecycle", "Join [eval_license_id", 1),
        ("layer_acquisitions", "Join [addon_license_id", 1),
        ("layer_fk_violations", "Join [value", 1),
    ],
)
def test_joins_of_bucketed_tables_need_no_exchange(spark, no_broadcast, name, join, n_joins):
    free = [text for text in below(plan(spark, name), join) if "Exchange" not in text]
    assert len(free) >= n_joins
    assert all("Bucketed: true" in text for text in free)
    unbucketed = name.removeprefix("layer_")
    assert all("Exchange" in text for text in below(plan(spark, unbucketed), join))


def test_first_sales_of_conversions_need_no_exchange(spark, no_broadcast):
    """The join inside the written conversions, and the grouping below it."""
    feed = registered._feed(spark, SF_DIR).written
    rows = registered.subscriptions.trial_conversions(feed.licenses, feed.transactions)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join [commercial_license_id" in text and "Exchange" not in text


def test_month_filters_choose_folders(spark):
    text = plan(spark, "layer_engagement_signal")
    assert re.search(r"PartitionFilters: \[[^]]*event_month#\d+ >= ", text)
    text = plan(spark, "layer_revenue_signal")
    assert re.search(r"PartitionFilters: \[[^]]*sale_month#\d+ = Subquery", text)


def test_the_gate_counts_in_the_writing_job(spark):
    """One scan of the rows: the counters sit in the plan that writes them."""
    contract = registered.CONTRACTS[registered.LICENSES]
    rows = registered._feed(spark, SF_DIR).written.licenses
    text = registered.quality.observed(rows, contract).rows._jdf.queryExecution().executedPlan().toString()
    assert text.count("CollectMetrics") == 1 and text.count("FileScan") == 1 and "Exchange" not in text


def test_last_month_needs_no_windows_and_no_second_license_join(spark):
    text = plan(spark, "revenue_signal")
    assert "Window" not in text


def test_revenue_rows_are_never_grouped_whole(spark):
    """Every exchange below the row-level windows carries a date or a spread."""
    text = plan(spark, "mrr_movement")
    windows = [line for line in text.splitlines() if "Exchange hashpartitioning(host_license_id" in line or "Exchange hashpartitioning(instance_id" in line]
    assert windows and all("sale_date" in line or "_spread" in line for line in windows)


@pytest.mark.parametrize("name", ["feature_usage", "customers", "engagement_signal", "trial_conversion", "annual_cohort_matrix"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in plan(spark, name)


def test_the_counts_share_one_shuffle_of_the_events(spark):
    df = registered.queries()["feature_usage"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_the_cohort_matrix_looks_months_up(spark):
    """No conditional sum per month and row."""
    assert plan(spark, "annual_cohort_matrix").count("CASE WHEN (revenue_month") < 5
