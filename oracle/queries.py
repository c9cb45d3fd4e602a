"""One statement per registered query. Names and types match the Spark results."""

from __future__ import annotations

from oracle.sources import month, moment, month_index, rounded, text, with_tables

LICENSE_TEXT = (
    "license_id, app_entitlement_number, host_license_id, host_entitlement_number, cloud_id, "
    "cloud_site_hostname, addon_key, addon_name, hosting"
)


def r(column: str, digits: int = 4) -> str:
    return f"{rounded(column, digits)} AS {column}"


def as_bigint(*columns: str) -> str:
    return ", ".join(f"CAST({column} AS BIGINT) AS {column}" for column in columns)


MRR_TEXT = ", ".join(
    text(column)
    for column in (
        "sale_date", "sale_month", "maintenance_start_date", "maintenance_end_date",
        "prev_renewal_month", "expected_next_renewal_month",
    )
)

STG_TRANSACTIONS = f"""
    SELECT transaction_id, addon_license_id, license_id, app_entitlement_number, addon_key, addon_name, hosting,
           {text('sale_date')}, sale_type, {r('purchase_price')}, {r('vendor_amount')}, billing_period, tier,
           {text('maintenance_start_date')}, {text('maintenance_end_date')}, sale_channel, parent_product_name,
           parent_product_edition, {r('loyalty_discount')}, {r('marketplace_promotion_discount')},
           {r('expert_discount')}, is_zero_value, is_refund, {moment('extracted_at')}, {moment('loaded_at')}
    FROM tx"""

CHURN = f"""
    SELECT {text('sale_month')}, addon_key, addon_name, billing_period,
           {', '.join(r(c) for c in ('new_mrr', 'renewal_mrr', 'expansion_mrr', 'contraction_mrr',
                                     'reactivation_mrr', 'total_mrr', 'beginning_mrr'))},
           new_logos, renewing_logos, total_logos, zero_value_logos, beginning_logos,
           {rounded("(renewal_mrr + expansion_mrr - contraction_mrr) / nullif(beginning_mrr, 0)")} AS nrr,
           {rounded("1.0 - CAST(renewing_logos AS DOUBLE) / nullif(beginning_logos, 0)")} AS logo_churn_rate
    FROM churn"""


def trial_conversion(expired: str) -> str:
    return f"""
    SELECT {text('eval_cohort_month')}, addon_key, total_trials, converted_count,
           {expired} AS expired_count, active_trial_count,
           {rounded(f"CAST(converted_count AS DOUBLE) / nullif(converted_count + {expired}, 0)")} AS conversion_rate,
           {r('avg_days_to_convert')}, {r('median_days_to_convert')}, {r('cohort_converted_arr')}
    FROM conversion"""


COHORT_CELLS = ", ".join(
    f"CAST(round(CAST(sum(amount) FILTER (WHERE revenue_month = DATE '{i // 12}-{i % 12 + 1:02d}-01') / 12.0 "
    f"AS DECIMAL(30, 6)), 2) AS DOUBLE) AS m_{i // 12}_{i % 12 + 1:02d}"
    for i in range(2017 * 12 + 6, 2017 * 12 + 6 + 92)
)

NOT_NULL = {
    "stg_marketplace_licenses": (
        "lic",
        "addon_license_id license_id host_license_id addon_key addon_name hosting last_updated license_type "
        "maintenance_start_date maintenance_end_date status tier company country region tech_contact_email "
        "tech_contact_name extracted_at loaded_at",
    ),
    "stg_marketplace_transactions": (
        "tx",
        "transaction_id addon_license_id license_id addon_key addon_name hosting sale_date sale_type purchase_price "
        "vendor_amount billing_period tier maintenance_start_date maintenance_end_date sale_channel "
        "parent_product_name parent_product_edition loyalty_discount marketplace_promotion_discount "
        "expert_discount extracted_at loaded_at",
    ),
    "stg_amplitude_events": (
        "ev",
        "event_id event_type event_time device_id platform event_source product session_id extracted_at loaded_at",
    ),
}
NOT_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) FILTER (WHERE {column} IS NULL) AS n_failures "
    f"FROM {source}"
    for table, (source, columns) in NOT_NULL.items()
    for column in columns.split()
)

# All columns of the cleaned sources, by kind.
PROFILED = {
    "stg_marketplace_licenses": (
        "lic",
        {
            "number": "addon_license_id evaluation_license",
            "amount": "days_to_convert_eval",
            "date": "maintenance_start_date maintenance_end_date evaluation_start_date evaluation_end_date evaluation_sale_date",
            "moment": "last_updated extracted_at loaded_at",
            "flag": "is_evaluation is_active is_converted",
            "text": "license_id app_entitlement_number host_license_id host_entitlement_number cloud_id "
            "cloud_site_hostname addon_key addon_name hosting license_type status tier company country region "
            "tech_contact_email tech_contact_name evaluation_opportunity_size",
        },
    ),
    "stg_marketplace_transactions": (
        "tx",
        {
            "number": "addon_license_id",
            "amount": "purchase_price vendor_amount loyalty_discount marketplace_promotion_discount expert_discount",
            "date": "sale_date maintenance_start_date maintenance_end_date",
            "moment": "extracted_at loaded_at",
            "flag": "is_zero_value is_refund",
            "text": "transaction_id license_id app_entitlement_number addon_key addon_name hosting sale_type "
            "billing_period tier sale_channel parent_product_name parent_product_edition",
        },
    ),
    "stg_amplitude_events": (
        "ev",
        {
            "number": "session_id",
            "moment": "event_time extracted_at loaded_at",
            "flag": "is_anonymous is_bot is_test_event",
            "text": "event_id event_type user_id device_id platform event_source product user_property_company "
            "user_property_plan user_property_tier country region",
            "properties": "event_properties",
        },
    ),
}
CONTRACT_KINDS = {
    "number": "integer", "amount": "float", "flag": "boolean", "moment": "timestamp_tz",
    "date": "varchar", "text": "varchar", "properties": "varchar",
}


def profiled(table: str, source: str, kind: str, column: str) -> str:
    exact = f"CAST({column} AS DECIMAL(30, 4))" if kind == "amount" else column
    number = f"CAST({exact} AS DOUBLE)" if kind in ("number", "amount") else "CAST(NULL AS DOUBLE)"
    value = {
        "date": f"strftime({column}, '%Y-%m-%d')",
        "moment": f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')",
        "properties": "'{\"k\":' || event_property_k || '}'",
    }.get(kind, f"CAST({exact} AS VARCHAR)")
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{CONTRACT_KINDS[kind]}' AS data_type, "
        f"{value} AS value, {number} AS number FROM {source}"
    )


LONG = " UNION ALL ".join(
    profiled(table, source, kind, column)
    for table, (source, kinds) in PROFILED.items()
    for kind, columns in kinds.items()
    for column in columns.split()
)
COUNTED = f"SELECT table_name, column_name, data_type, value, number, count(*) AS n FROM ({LONG}) GROUP BY ALL"

SQL: dict[str, str] = {
    "raw_landing": f"""
        SELECT transaction_id, {text('sale_date')}, upper(sale_type) AS sale_type, {r('purchase_price')},
               {moment('extracted_at')}, TRUE AS is_gzip
        FROM (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE CAST(transaction_id AS BIGINT) % 100 = 3)""",
    "raw_quarantine": """
        SELECT '{"payload":{"transaction_id":"' || transaction_id AS raw_text, TRUE AS is_gzip
        FROM tx WHERE CAST(transaction_id AS BIGINT) % 50 = 7""",
    "incremental_ingest": f"""
        SELECT CASE WHEN sale_date < DATE '2022-01-01' THEN 1 ELSE 2 END AS load_no,
               count(*) AS n_rows, CAST(sum(CAST(purchase_price AS DECIMAL(18, 4))) AS DOUBLE) AS price_sum
        FROM tx GROUP BY ALL""",
    "full_refresh": f"""
        SELECT sale_type, count(*) AS n_rows, CAST(sum(CAST(purchase_price AS DECIMAL(18, 4))) AS DOUBLE) AS price_sum,
               CAST(sum(CAST(vendor_amount AS DECIMAL(18, 4))) AS DOUBLE) AS vendor_sum
        FROM tx GROUP BY ALL""",
    "high_water_mark": f"""
        SELECT event_id, {moment('loaded_at')} FROM ev
        WHERE loaded_at > (SELECT max(loaded_at) FROM ev WHERE event_time < TIMESTAMP '2024-01-16 00:00:00')""",
    "upsert_by_key": f"""
        SELECT transaction_id, {text('sale_date')}, sale_type, {r('purchase_price')},
               CASE WHEN sale_type = 'REFUND' THEN 0.0 ELSE {rounded('vendor_amount')} END AS vendor_amount
        FROM tx""",
    "stg_licenses": f"""
        SELECT addon_license_id, {LICENSE_TEXT}, {moment('last_updated')}, license_type,
               {text('maintenance_start_date')}, {text('maintenance_end_date')}, status, tier, company, country, region,
               tech_contact_email, tech_contact_name, evaluation_opportunity_size, evaluation_license,
               {r('days_to_convert_eval')}, {text('evaluation_start_date')}, {text('evaluation_end_date')},
               {text('evaluation_sale_date')}, is_evaluation, is_active, is_converted,
               {moment('extracted_at')}, {moment('loaded_at')}
        FROM lic""",
    "stg_transactions": STG_TRANSACTIONS,
    "stg_events": f"""
        SELECT event_id, event_type, {moment('event_time')}, user_id, device_id, platform, event_source, product,
               event_property_k, user_property_company, user_property_plan, user_property_tier, session_id, country,
               region, is_anonymous, is_bot, is_test_event, {moment('extracted_at')}, {moment('loaded_at')}
        FROM ev""",
    "latest_per_key": f"SELECT addon_license_id, {moment('last_updated')}, status FROM lic",
    "company_key": """
        SELECT DISTINCT user_property_company AS company, country_iso, company_key FROM keyed""",
    "iso_country": "SELECT country, country_iso, count(*) AS n_licenses FROM lic_iso GROUP BY ALL",
    "customers": f"""
        SELECT instance_id, cloud_id, host_license_id, hosting, country_iso, company_key, has_active_license,
               product_count, product_count_active, products, {moment('last_updated')}
        FROM hub""",
    "company_bridge": "SELECT event_id, company_key, instance_id, is_matched FROM bridged",
    "feature_usage": f"""
        SELECT {text('event_month')}, product, event_type, company_key, instance_id, is_matched, event_count,
               unique_users, unique_sessions, anonymous_device_count
        FROM usage""",
    "match_rate": f"""
        SELECT count(*) AS keyed_events, count(*) FILTER (WHERE n > 0) AS matched_events,
               CAST(sum(greatest(n, 1)) AS BIGINT) AS bridged_rows,
               {rounded('avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)')} AS match_rate
        FROM (SELECT keyed.event_id, count(instance_id) AS n FROM keyed LEFT JOIN hub USING (company_key)
              WHERE company_key IS NOT NULL GROUP BY keyed.event_id)""",
    "monthly_mrr": f"""
        SELECT transaction_id, addon_license_id, instance_id, cloud_id, host_license_id, addon_key, addon_name,
               hosting, company, country, {MRR_TEXT}, sale_type, billing_period, {r('purchase_price')},
               {r('vendor_amount')}, {r('mrr')}, tier, sale_channel, is_zero_value, is_refund, is_renewal_gap
        FROM mrr_rows""",
    "renewal_gap": f"""
        SELECT billing_period, sale_type, {month_index('sale_month')} - {month_index('prev_renewal_month')} AS gap,
               is_renewal_gap, count(*) AS n_rows
        FROM mrr_rows GROUP BY ALL""",
    "first_sale": f"SELECT addon_license_id, {text('first_sale_date')}, {r('total_arr')} FROM first_sales",
    "trial_lifecycle": f"""
        SELECT eval_license_id, addon_key, instance_id, company, country, hosting, eval_tier,
               {text('eval_start_date')}, {text('eval_end_date')}, commercial_license_id,
               {text('commercial_start_date')}, commercial_tier, {r('days_to_convert_eval')},
               {text('first_sale_date')}, {r('converted_arr')}, trial_outcome, is_converted, is_expired_no_convert,
               {text('eval_cohort_month')}
        FROM trials""",
    "trial_outcome": """
        SELECT hosting, trial_outcome, is_converted, is_expired_no_convert, count(*) AS n_trials
        FROM trials GROUP BY ALL""",
    "acquisitions": f"SELECT instance_id, addon_key, {text('cohort_month')} FROM acquired",
    "month_spread": f"""
        SELECT {text('cohort_month')}, addon_key, {text('txn_month')}, {text('revenue_month')},
               CAST(sum(amount) AS DOUBLE) AS amount
        FROM spread GROUP BY spread.cohort_month, addon_key, spread.txn_month, spread.revenue_month""",
    "annual_cohort_matrix": f"""
        SELECT {text('cohort_month')}, addon_key, count(DISTINCT instance_id) AS cohort_size, {COHORT_CELLS}
        FROM spread GROUP BY spread.cohort_month, addon_key""",
    "prior_mrr": f"SELECT transaction_id, billing_period, {r('mrr')}, {r('prior_mrr')} FROM prior",
    "mrr_movement": f"SELECT transaction_id, mrr_movement_type, {r('mrr')} FROM moved",
    "active_customers": f"""
        SELECT {text('sale_month')}, addon_key, addon_name, hosting, instance_id, company, country,
               {r('monthly_mrr')}, transaction_count, has_zero_value_tx, active_workspaces_per_product_month,
               total_active_workspaces_month
        FROM active""",
    "trial_conversion": trial_conversion("expired_count"),
    "trial_conversion_literal": trial_conversion("CAST(0 AS BIGINT)"),
    "mrr_churn": CHURN,
    "usage_by_trial": f"""
        SELECT {text('event_month')}, product, event_type, company_key, instance_id, customer_cohort,
               count(*) AS n_trials, max(event_count) AS event_count
        FROM trial_usage GROUP BY trial_usage.event_month, product, event_type, company_key, instance_id, customer_cohort""",
    "feature_adoption": f"""
        SELECT {text('event_month')}, product, event_type, customer_cohort, workspace_count,
               {as_bigint('total_events', 'total_unique_users', 'total_unique_sessions')},
               {r('avg_events_per_workspace')}, {r('avg_users_per_workspace')}, {r('feature_adoption_rate')}
        FROM adoption""",
    "license_signal": f"""
        SELECT instance_id, company, country, has_active_license, product_count, {text('latest_maintenance_end')},
               days_since_maintenance_end
        FROM license_side""",
    "revenue_signal": f"SELECT instance_id, {r('current_mrr')}, {text('last_transaction_month')} FROM revenue_side",
    "median_mrr": f"SELECT {r('med_mrr')} FROM median_side",
    "engagement_signal": f"""
        SELECT instance_id, events_90d, distinct_features_90d, unique_users_90d, {text('last_active_month')}
        FROM usage_side""",
    "customer_health": f"""
        SELECT instance_id, company, country, product_count, has_active_license, {text('latest_maintenance_end')},
               days_since_maintenance_end, {r('current_mrr')}, {text('last_transaction_month')}, events_90d,
               distinct_features_90d, unique_users_90d, {text('last_active_month')}, license_score, revenue_score,
               engagement_score, {rounded('score', 1)} AS health_score,
               CASE WHEN score >= 75 THEN 'healthy' WHEN score >= 50 THEN 'at_risk'
                    ELSE 'churned_or_inactive' END AS health_segment
        FROM (SELECT *, (license_score * 4 + revenue_score * 3 + engagement_score * 3) / 10.0 AS score FROM health)""",
    "report_active_customers": f"""
        SELECT DISTINCT {text('sale_month')}, addon_key, replace(addon_key, 'com.acme.', '') AS product,
               active_workspaces_per_product_month AS active_customers
        FROM active WHERE active.sale_month < DATE '2024-03-01'""",
    "report_trial_conversion": f"""
        SELECT replace(addon_key, 'com.acme.', '') AS product, {as_bigint('total_trials', 'converted')},
               {rounded('CAST(converted AS DOUBLE) / total_trials * 100', 1)} AS conversion_rate_pct,
               {r('avg_days_to_convert', 1)}
        FROM (SELECT addon_key, sum(total_trials) AS total_trials, sum(converted_count) AS converted,
                     avg(avg_days_to_convert) AS avg_days_to_convert
              FROM conversion WHERE converted_count + expired_count > 0 GROUP BY addon_key)""",
    "report_nrr_churn": f"""
        SELECT {text('sale_month')}, {r('total_mrr', 2)},
               {rounded('retained / nullif(beginning_mrr, 0) * 100', 1)} AS nrr_pct,
               {rounded('(1 - CAST(renewing_logos AS DOUBLE) / nullif(beginning_logos, 0)) * 100', 1)} AS logo_churn_pct,
               {as_bigint('new_logos', 'total_logos')}
        FROM (SELECT sale_month, sum(total_mrr) AS total_mrr, sum(beginning_mrr) AS beginning_mrr,
                     sum(renewal_mrr + expansion_mrr - contraction_mrr) AS retained,
                     sum(renewing_logos) AS renewing_logos, sum(beginning_logos) AS beginning_logos,
                     sum(new_logos) AS new_logos, sum(total_logos) AS total_logos
              FROM churn WHERE billing_period = 'Monthly' AND sale_month >= DATE '2023-09-01'
                AND sale_month < DATE '2024-03-01' GROUP BY sale_month)""",
    "report_feature_signal": f"""
        SELECT product, event_type, converted, expired, conversion_signal_ratio, CAST(rn AS INTEGER) AS rn
        FROM (SELECT *, row_number() OVER (PARTITION BY product
                            ORDER BY conversion_signal_ratio DESC NULLS FIRST, event_type) AS rn
              FROM (SELECT product, event_type, {r('converted', 1)}, {r('expired', 1)},
                           {rounded('converted / nullif(expired, 0)', 1)} AS conversion_signal_ratio
                    FROM (SELECT product, event_type,
                                 max(avg_events_per_workspace) FILTER (WHERE customer_cohort = 'converted') AS converted,
                                 max(avg_events_per_workspace) FILTER (WHERE customer_cohort = 'expired') AS expired
                          FROM adoption GROUP BY ALL) WHERE converted IS NOT NULL)) WHERE rn <= 3""",
    "finding_multi_product": f"""
        SELECT count(*) AS workspaces, count(*) FILTER (WHERE product_count > 1) AS multi_product_workspaces,
               {rounded('avg(CASE WHEN product_count > 1 THEN 1.0 ELSE 0.0 END)')} AS multi_product_share
        FROM hub""",
    "finding_mau_per_license": f"""
        SELECT product, customers, active_licenses, {r('avg_monthly_users')},
               {rounded('avg_monthly_users / nullif(active_licenses, 0)')} AS users_per_active_license
        FROM (SELECT replace(addon_key, 'com.acme.', '') AS product, count(DISTINCT host_license_id) AS customers,
                     count(DISTINCT host_license_id) FILTER (WHERE is_active) AS active_licenses
              FROM lic GROUP BY ALL)
        LEFT JOIN (SELECT product, avg(users) AS avg_monthly_users
                   FROM (SELECT product, event_month, count(DISTINCT user_id) AS users FROM keyed GROUP BY ALL)
                   GROUP BY product) USING (product)""",
    "finding_zero_value_trials": f"""
        SELECT resolved_trials, converted_trials, zero_value_converted,
               {rounded('CAST(converted_trials AS DOUBLE) / resolved_trials')} AS conversion_rate,
               {rounded('CAST(converted_trials - zero_value_converted AS DOUBLE) / resolved_trials')} AS paid_conversion_rate
        FROM (SELECT count(*) FILTER (WHERE trial_outcome <> 'active_trial') AS resolved_trials,
                     count(*) FILTER (WHERE is_converted) AS converted_trials,
                     count(*) FILTER (WHERE is_converted AND converted_arr = 0) AS zero_value_converted
              FROM trials)""",
    "finding_zero_value_customers": f"""
        SELECT count(*) AS workspaces, count(*) FILTER (WHERE only_zero) AS zero_value_workspaces,
               {rounded('avg(CASE WHEN only_zero THEN 1.0 ELSE 0.0 END)')} AS zero_value_share
        FROM (SELECT instance_id, bool_and(is_zero_value) AS only_zero FROM mrr_rows
              WHERE sale_type = 'NEW' AND instance_id IS NOT NULL GROUP BY instance_id)""",
    "finding_feature_depth": """
        SELECT product, CASE WHEN features >= 10 THEN '10+' WHEN features >= 5 THEN '5-9' ELSE '1-4' END AS features_used,
               count(*) AS workspaces
        FROM (SELECT product, instance_id, count(DISTINCT event_type) AS features FROM usage
              WHERE is_matched GROUP BY ALL) GROUP BY ALL""",
    "check_not_null": NOT_NULL_SQL,
    "check_unique": """
        SELECT 'stg_marketplace_licenses' AS table_name, 'addon_license_id' AS column_name,
               CAST(addon_license_id AS VARCHAR) AS value, CAST(2 AS BIGINT) AS n_records
        FROM lic WHERE addon_license_id % 37 = 0
        UNION ALL SELECT 'stg_marketplace_transactions', 'transaction_id', transaction_id, 2
        FROM tx WHERE CAST(transaction_id AS BIGINT) % 100 = 3
        UNION ALL SELECT 'stg_amplitude_events', 'event_id', event_id, 2
        FROM ev WHERE CAST(event_id AS BIGINT) % 500 = 0""",
    "check_accepted_values": """
        SELECT table_name, column_name, value, count(*) AS n_records FROM (
            SELECT 'stg_marketplace_licenses' AS table_name, 'hosting' AS column_name,
                   (['cloud', 'Server', ' data center'])[CAST(host_license_id AS BIGINT) % 3 + 1] AS value FROM lic
            UNION ALL SELECT 'stg_marketplace_licenses', 'license_type',
                   CASE WHEN is_evaluation THEN 'EVALUATION' ELSE 'Commercial' END FROM lic
            UNION ALL SELECT 'stg_marketplace_licenses', 'status',
                   (['active', 'Active', ' ACTIVE', 'ACTV', 'expired ', 'Cancelled'])[addon_license_id % 6 + 1] FROM lic
            UNION ALL SELECT 'stg_marketplace_transactions', 'hosting',
                   (['cloud', 'Server', ' data center'])[addon_license_id // 100 % 3 + 1] FROM tx
            UNION ALL SELECT 'stg_marketplace_transactions', 'sale_type',
                   upper(sale_type[1]) || lower(sale_type[2:]) FROM tx)
        WHERE value NOT IN ('cloud', 'active') GROUP BY ALL""",
    "fk_violations": """
        SELECT 'stg_marketplace_transactions' AS table_name, 'addon_license_id' AS column_name,
               CAST(addon_license_id AS VARCHAR) AS value, count(*) AS n_records
        FROM tx WHERE addon_license_id NOT IN (SELECT addon_license_id FROM lic) GROUP BY ALL
        UNION ALL SELECT 'stg_amplitude_events', 'company_key', company_key, count(*)
        FROM keyed WHERE company_key NOT IN (SELECT company_key FROM hub) GROUP BY ALL""",
    "contract_summary": """
        SELECT 'stg_marketplace_licenses' AS table_name, 'addon_license_id' AS column_name,
               CAST(2 * count(*) AS BIGINT) AS n_failures, 'unique' AS "check" FROM lic WHERE addon_license_id % 37 = 0
        UNION ALL SELECT 'stg_marketplace_transactions', 'transaction_id', 2 * count(*), 'unique'
        FROM tx WHERE CAST(transaction_id AS BIGINT) % 100 = 3
        UNION ALL SELECT 'stg_amplitude_events', 'event_id', 2 * count(*), 'unique'
        FROM ev WHERE CAST(event_id AS BIGINT) % 500 = 0""",
    "profile": f"""
        SELECT table_name, column_name, CAST(sum(n) AS BIGINT) AS n_rows,
               CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS n_missing,
               count(value) AS n_distinct, count(value) FILTER (WHERE n = 1) AS n_unique,
               CAST(coalesce(sum(n) FILTER (WHERE trim(value) = ''), 0) AS BIGINT) AS n_blank,
               CAST(coalesce(sum(n) FILTER (WHERE number = 0), 0) AS BIGINT) AS n_zero,
               CAST(coalesce(sum(n) FILTER (WHERE number < 0), 0) AS BIGINT) AS n_negative,
               {rounded('min(number)')} AS min_number, {rounded('max(number)')} AS max_number,
               {rounded('sum(number * n) / sum(n) FILTER (WHERE number IS NOT NULL)')} AS mean_number,
               min(value) AS min_text, max(value) AS max_text,
               coalesce(max(n) FILTER (WHERE value IS NOT NULL), 0) AS top_count,
               arg_max(value, n * 1000000000 + place) FILTER (WHERE value IS NOT NULL) AS top_value
        FROM (SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY value) AS place FROM ({COUNTED}))
        GROUP BY table_name, column_name""",
    "duplicate_rows": """
        SELECT 'stg_marketplace_licenses' AS table_name,
               count(*) + count(*) FILTER (WHERE addon_license_id % 37 = 0) AS n_rows,
               count(*) + count(*) FILTER (WHERE addon_license_id % 37 = 0) AS n_distinct_rows,
               CAST(0 AS BIGINT) AS n_duplicate_rows FROM lic
        UNION ALL SELECT 'stg_marketplace_transactions',
               count(*) + count(*) FILTER (WHERE CAST(transaction_id AS BIGINT) % 100 = 3), count(*),
               count(*) FILTER (WHERE CAST(transaction_id AS BIGINT) % 100 = 3) FROM tx
        UNION ALL SELECT 'stg_amplitude_events',
               count(*) + count(*) FILTER (WHERE CAST(event_id AS BIGINT) % 500 = 0), count(*),
               count(*) FILTER (WHERE CAST(event_id AS BIGINT) % 500 = 0) FROM ev""",
    "infer_contract": f"""
        SELECT table_name, table_name AS model, column_name, any_value(data_type) AS data_type,
               bool_or(value IS NULL) AS nullable,
               coalesce(max(n) FILTER (WHERE value IS NOT NULL), 0) = 1 AS is_unique,
               concat_ws(',', CASE WHEN NOT bool_or(value IS NULL) THEN 'not_null' END,
                         CASE WHEN coalesce(max(n) FILTER (WHERE value IS NOT NULL), 0) = 1 THEN 'unique' END) AS tests
        FROM ({COUNTED}) GROUP BY table_name, column_name""",
}

# Tables that are written in layers hold the rows of their models.
for _name in ("monthly_mrr", "trial_lifecycle", "acquisitions", "fk_violations", "revenue_signal", "engagement_signal"):
    SQL[f"layer_{_name}"] = SQL[_name]

SQL["contract_gate"] = f"""
    SELECT table_name, column_name, 'not_null' AS "check", n_failures FROM ({SQL['check_not_null']}) WHERE n_failures > 0
    UNION ALL SELECT table_name, column_name, 'accepted_values', CAST(sum(n_records) AS BIGINT)
    FROM ({SQL['check_accepted_values']}) GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}
