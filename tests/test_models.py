from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from subtide import ReportParams
from subtide.plans import customers, marts, reports, subscriptions

PARAMS = ReportParams(as_of=date(2024, 3, 1), product_prefix="x.", cohort_start=date(2023, 1, 1), cohort_periods=24)

LICENSES = (
    "addon_license_id bigint, host_license_id string, addon_key string, cloud_id string, company string, "
    "country string, hosting string, tier string, maintenance_start_date date, maintenance_end_date date, "
    "evaluation_license bigint, days_to_convert_eval double, is_evaluation boolean, is_active boolean, "
    "is_converted boolean, last_updated timestamp"
)
TRANSACTIONS = (
    "transaction_id string, addon_license_id bigint, addon_key string, addon_name string, hosting string, "
    "sale_date date, sale_type string, purchase_price double, vendor_amount double, billing_period string, "
    "tier string, maintenance_start_date date, maintenance_end_date date, sale_channel string, "
    "is_zero_value boolean, is_refund boolean"
)


def license_row(number, host="w1", **changes):
    row = {
        "addon_license_id": number, "host_license_id": host, "addon_key": "x.app", "cloud_id": None,
        "company": "Acme Inc", "country": "Germany", "hosting": "cloud", "tier": "T",
        "maintenance_start_date": date(2023, 1, 1), "maintenance_end_date": date(2023, 2, 1),
        "evaluation_license": None, "days_to_convert_eval": None, "is_evaluation": False,
        "is_active": True, "is_converted": False, "last_updated": None,
    }
    return {**row, **changes}


def sale(number, license_id, day, kind="RENEWAL", price=10.0, period="Monthly", **changes):
    row = {
        "transaction_id": f"t{number:03d}", "addon_license_id": license_id, "addon_key": "x.app",
        "addon_name": "App", "hosting": "cloud", "sale_date": day, "sale_type": kind, "purchase_price": price,
        "vendor_amount": price, "billing_period": period, "tier": "T", "maintenance_start_date": day,
        "maintenance_end_date": day, "sale_channel": "direct",
        "is_zero_value": None if price is None else price == 0,
        "is_refund": None if price is None else price < 0,
    }
    return {**row, **changes}


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(row.values()) for row in rows], schema)


@pytest.fixture
def subscriptions_of(spark):
    def build(license_rows, sales):
        return frame(spark, license_rows, LICENSES), frame(spark, sales, TRANSACTIONS)

    return build


def test_monthly_mrr_rows_and_previous_month(subscriptions_of):
    licenses, sales = subscriptions_of(
        [license_row(1)],
        [
            sale(1, 1, date(2023, 1, 5), "NEW"),
            sale(2, 1, date(2023, 1, 20)),
            sale(3, 1, date(2023, 4, 1)),
            sale(4, 1, date(2023, 5, 1), "UPGRADE"),
            sale(5, 1, date(2023, 5, 2), price=-3.0),
            sale(6, 1, date(2023, 5, 3), price=None),
            sale(7, 99, date(2023, 6, 1), price=0.0),
        ],
    )
    rows = {r.transaction_id: r for r in subscriptions.monthly_mrr(sales, licenses).collect()}
    assert sorted(rows) == ["t001", "t002", "t003", "t007"]
    assert rows["t002"].prev_renewal_month == date(2023, 1, 1) and not rows["t002"].is_renewal_gap
    assert rows["t003"].prev_renewal_month == date(2023, 1, 1) and rows["t003"].is_renewal_gap
    assert rows["t007"].instance_id is None and rows["t007"].mrr == 0.0


def test_movements_add_up_to_the_total(subscriptions_of):
    sales = [
        sale(1, 1, date(2023, 1, 1), "NEW", 10.0),
        sale(2, 1, date(2023, 2, 1), price=15.0),
        sale(3, 1, date(2023, 3, 1), price=12.0),
        sale(4, 1, date(2023, 4, 1), price=12.0),
        sale(5, 1, date(2023, 9, 1), price=50.0),
        sale(6, 2, date(2023, 2, 1), price=7.0),
        sale(7, 2, date(2023, 3, 1), price=0.0),
    ]
    licenses, sold = subscriptions_of([license_row(1), license_row(2, "w2")], sales)
    mrr = subscriptions.monthly_mrr(sold, licenses)
    kinds = {r.transaction_id: r.mrr_movement_type for r in marts.movements(mrr).collect()}
    assert kinds == {
        "t001": "new", "t002": "expansion", "t003": "contraction", "t004": "renewal",
        "t005": "reactivation", "t006": "renewal", "t007": "contraction",
    }
    rows = {r.sale_month: r for r in marts.mrr_churn(mrr).collect()}
    for row in rows.values():
        parts = row.new_mrr + row.renewal_mrr + row.expansion_mrr + row.contraction_mrr + row.reactivation_mrr
        assert parts == pytest.approx(row.total_mrr)
    march = rows[date(2023, 3, 1)]
    assert march.beginning_mrr == 22.0 and march.beginning_logos == 2 and march.zero_value_logos == 1
    assert march.nrr == pytest.approx(round(-12.0 / 22.0, 4)) and march.logo_churn_rate == 1.0
    assert rows[date(2023, 1, 1)].nrr is None and rows[date(2023, 1, 1)].logo_churn_rate is None


def test_trial_outcomes_and_fan_out(subscriptions_of):
    def trial(number, end):
        return license_row(number, is_evaluation=True, maintenance_end_date=end)

    licenses, sales = subscriptions_of(
        [
            trial(1, date(2024, 3, 1)),
            trial(2, date(2024, 2, 29)),
            trial(3, date(2023, 1, 1)),
            license_row(31, is_converted=True, evaluation_license=3, days_to_convert_eval=4.0),
            license_row(32, is_converted=True, evaluation_license=3, days_to_convert_eval=8.0),
        ],
        [sale(1, 31, date(2023, 1, 2), "NEW", 0.0), sale(2, 31, date(2023, 1, 1), "NEW", 5.0), sale(3, 32, date(2023, 2, 1))],
    )
    trials = subscriptions.trial_lifecycle(licenses, sales, PARAMS)
    found = [(r.eval_license_id, r.trial_outcome, r.is_expired_no_convert, r.converted_arr) for r in trials.collect()]
    rows = sorted(found, key=str)
    assert rows[:2] == [(1, "active_trial", False, None), (2, "expired", True, None)]
    assert rows[2:] == [(3, "converted", False, 5.0), (3, "converted", False, None)]

    [row] = marts.trial_conversion(trials, PARAMS).collect()
    assert (row.total_trials, row.converted_count, row.expired_count, row.active_trial_count) == (4, 2, 1, 1)
    assert row.conversion_rate == 0.6667 and row.median_days_to_convert == 6.0 and row.cohort_converted_arr == 5.0
    [coded] = marts.trial_conversion(trials, replace(PARAMS, literal=True)).collect()
    assert coded.expired_count == 0 and coded.conversion_rate == 1.0
    [found] = reports.zero_value_trials(trials).collect()
    assert (found.resolved_trials, found.converted_trials, found.zero_value_converted) == (3, 2, 0)


def test_annual_cohort_spreads_the_whole_price(subscriptions_of):
    licenses, sales = subscriptions_of(
        [license_row(1), license_row(2, "w2")],
        [
            sale(1, 1, date(2023, 3, 9), "NEW", 120.0, "Annual"),
            sale(2, 1, date(2024, 3, 9), price=60.06, period="annual"),
            sale(3, 1, date(2022, 12, 1), price=12.0, period="Annual"),
            sale(4, 2, date(2023, 3, 1), price=999.0, period="Annual"),
        ],
    )
    [row] = subscriptions.annual_cohort_matrix(sales, licenses, PARAMS).collect()
    months = [row[f"m_{m:%Y_%m}"] for m in PARAMS.cohort_months()]
    assert row.cohort_month == date(2023, 3, 1) and row.cohort_size == 1
    assert months[:2] == [None, None] and months[2:11] == [11.0] * 9 and months[11:14] == [10.0] * 3
    # 60.06 / 12 is 5.005: half a cent, rounded up.
    assert months[14:] == [5.01] * 10


def test_customers_and_usage_fan_out(spark, subscriptions_of):
    licenses, _ = subscriptions_of(
        [
            license_row(1, "w1"), license_row(2, "w1", addon_key="x.other", is_active=False),
            license_row(3, "w2"), license_row(4, "w3", company="Lone AG", country="Narnia"),
        ],
        [],
    )
    known = spark.createDataFrame([("germany", "DE")], "country_name string, iso_code string")
    hub = customers.customers(licenses, known, ["inc", "ag"])
    rows = {r.instance_id: r for r in hub.collect()}
    assert rows["w1"].company_key == "acme|de" and rows["w3"].company_key == "lone|narnia"
    assert rows["w1"].products == ["x.app", "x.other"]
    assert (rows["w1"].product_count, rows["w1"].product_count_active) == (2, 1)

    events = [
        ("e1", "open", "u1", "d1", 1, "app", "ACME", False, False, False),
        ("e2", "open", None, "d2", 2, "app", "Acme Inc.", True, False, False),
        ("e3", "open", "u1", "d1", 1, "app", None, False, False, False),
        ("e4", "open", "u9", "bot", 3, "app", "Acme", False, True, False),
        ("e5", "test", "u9", "d9", 3, "app", "Acme", False, False, True),
        ("e6", "open", "u2", "d3", 4, "app", "Stranger", False, False, False),
    ]
    typed = spark.createDataFrame(
        events,
        "event_id string, event_type string, user_id string, device_id string, session_id bigint, product string, "
        "user_property_company string, is_anonymous boolean, is_bot boolean, is_test_event boolean",
    ).withColumns({"event_time": F.lit("2024-02-03").cast("timestamp"), "country": F.lit("Germany")})
    keyed = customers.keyed_events(typed, known, ["inc", "ag"])
    usage = {(r.company_key, r.instance_id): r for r in customers.feature_usage(keyed, hub).collect()}
    assert set(usage) == {("acme|de", "w1"), ("acme|de", "w2"), (None, None), ("stranger|de", None)}
    shared = usage[("acme|de", "w2")]
    assert (shared.event_count, shared.unique_users, shared.unique_sessions, shared.anonymous_device_count) == (2, 1, 2, 1)
    assert shared.is_matched and not usage[(None, None)].is_matched
    [rate] = customers.match_rate(keyed, hub).collect()
    assert (rate.keyed_events, rate.matched_events, rate.bridged_rows) == (3, 2, 5)
    bridged = customers.bridge(keyed, hub, spread_by="event_id")
    assert bridged.count() == 6


def test_health_without_any_revenue(spark, subscriptions_of):
    licenses, sales = subscriptions_of(
        [
            license_row(1, "w1"), license_row(2, "w1", company="Other"),
            license_row(3, "w2", is_active=False, maintenance_end_date=date(2024, 9, 1)),
            license_row(4, "w3", is_active=False),
        ],
        [sale(1, 1, date(2024, 1, 1), price=0.0)],
    )
    usage = spark.createDataFrame(
        [(date(2024, 1, 1), f, "w1", True, 2, 1) for f in "abc"] + [(date(2023, 11, 1), "d", "w2", True, 9, 9)],
        "event_month date, event_type string, instance_id string, is_matched boolean, event_count bigint, unique_users bigint",
    )
    health = marts.customer_health(licenses, subscriptions.monthly_mrr(sales, licenses), usage, PARAMS)
    rows = {(r.instance_id, r.company): r for r in health.collect()}
    assert len(rows) == 4
    first = rows[("w1", "Acme Inc")]
    assert (first.license_score, first.revenue_score, first.engagement_score) == (100, 0, 75)
    assert first.health_score == 62.5 and first.health_segment == "at_risk" and first.events_90d == 6
    future = rows[("w2", "Acme Inc")]
    assert future.days_since_maintenance_end < 0 and future.license_score == 50 and future.events_90d == 0
    assert rows[("w3", "Acme Inc")].health_segment == "churned_or_inactive"


def test_adoption_and_feature_signal(spark):
    usage = spark.createDataFrame(
        [
            (date(2024, 1, 1), "app", "share", "w1", True, 6, 2, 3),
            (date(2024, 1, 1), "app", "share", "w2", True, 2, 1, 1),
            (date(2024, 1, 1), "app", "only", "w1", True, 4, 1, 1),
            (date(2024, 1, 1), "app", "share", None, False, 50, 9, 9),
            (date(2024, 1, 1), "app", "share", "w9", True, 1, 1, 1),
        ],
        "event_month date, product string, event_type string, instance_id string, is_matched boolean, "
        "event_count bigint, unique_users bigint, unique_sessions bigint",
    )
    trials = spark.createDataFrame(
        [("w1", "x.app", "converted"), ("w1", "x.app", "converted"), ("w2", "x.app", "expired"), (None, "x.app", "expired")],
        "instance_id string, addon_key string, trial_outcome string",
    )
    adoption = marts.feature_adoption(usage, trials, PARAMS)
    rows = {(r.event_type, r.customer_cohort): r for r in adoption.collect()}
    assert set(rows) == {("share", "converted"), ("share", "expired"), ("only", "converted"), ("share", "non_trial")}
    twice = rows[("share", "converted")]
    assert (twice.workspace_count, twice.total_events, twice.avg_events_per_workspace) == (1, 12, 6.0)
    assert twice.feature_adoption_rate == 1.0
    signal = sorted((r.rn, r.event_type, r.conversion_signal_ratio) for r in reports.feature_signal_report(adoption, PARAMS).collect())
    assert signal == [(1, "only", None), (2, "share", 3.0)]


def test_active_customers_and_report(subscriptions_of):
    licenses, sales = subscriptions_of(
        [license_row(1, "w1"), license_row(2, "w2"), license_row(3, "w1", addon_key="x.two")],
        [
            sale(1, 1, date(2024, 2, 1), "NEW"), sale(2, 2, date(2024, 2, 3), "NEW", 0.0),
            sale(3, 3, date(2024, 2, 9), "NEW", addon_key="x.two"), sale(4, 1, date(2024, 3, 1)),
        ],
    )
    active = marts.active_customers(subscriptions.monthly_mrr(sales, licenses))
    rows = {(r.sale_month, r.addon_key, r.instance_id): r for r in active.collect()}
    row = rows[(date(2024, 2, 1), "x.app", "w2")]
    assert row.active_workspaces_per_product_month == 2 and row.total_active_workspaces_month == 2
    assert row.has_zero_value_tx
    report = reports.active_customers_report(active, PARAMS).collect()
    assert sorted((r["product"], r.active_customers) for r in report) == [("app", 2), ("two", 1)]
    ordered = [r.sale_month for r in marts.presented(active, "mart_active_customers").collect()]
    assert ordered == sorted(ordered, reverse=True)
