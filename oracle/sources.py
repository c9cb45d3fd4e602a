"""The three sources and their cleaned form, as common table expressions.

They restate FIXTURES.md in SQL. ``with_tables`` puts only the expressions
that a statement needs, directly or not, in front of it.
"""

from __future__ import annotations

import re

from subtide.sources.seeds import LEGAL_SUFFIXES

SUFFIXES = "|".join(sorted(LEGAL_SUFFIXES, key=lambda suffix: (-len(suffix), suffix)))


def text(column: str) -> str:
    """Dates and timestamps as the text the registered queries return."""
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


def rounded(value: str, digits: int = 4) -> str:
    """Half-up rounding of a DOUBLE by its decimal form."""
    return f"CAST(round(CAST({value} AS DECIMAL(30, 8)), {digits}) AS DOUBLE)"


def company_key(company: str, country: str) -> str:
    stripped = f"regexp_replace(lower(trim({company})), '\\s+({SUFFIXES})\\.?\\s*$', '')"
    slug = f"trim(regexp_replace(trim({stripped}), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"({slug} || '|' || lower(coalesce({country}, '')))"


def month(value: str) -> str:
    return f"CAST(date_trunc('month', {value}) AS DATE)"


def month_index(value: str) -> str:
    return f"(year({value}) * 12 + month({value}))"


TABLES: dict[str, str] = {}

TABLES["sold"] = """
    SELECT o_orderkey AS order_id, o_custkey AS cust,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS p,
           CAST(o_orderdate AS DATE) + 8247 AS sale_date,
           o_totalprice AS amount
    FROM orders"""

TABLES["numbered"] = """
    SELECT *, row_number() OVER (PARTITION BY cust, p ORDER BY sale_date, order_id) AS rn FROM sold"""

TABLES["typed_sales"] = """
    SELECT *, CASE WHEN rn = 1 THEN 'NEW' WHEN order_id % 13 = 0 THEN 'REFUND'
                   WHEN order_id % 11 = 0 THEN 'UPGRADE' ELSE 'RENEWAL' END AS sale_type
    FROM numbered"""

TABLES["priced"] = """
    SELECT *, CASE WHEN sale_type = 'REFUND' THEN -amount WHEN order_id % 7 = 0 THEN 0.0
                   ELSE amount END AS purchase_price
    FROM typed_sales"""

TABLES["tx"] = """
    SELECT CAST(order_id AS VARCHAR) AS transaction_id, cust * 100 + p AS addon_license_id,
           'L' || (cust * 100 + p) AS license_id,
           CASE WHEN cust % 3 <> 0 THEN 'E' || cust END AS app_entitlement_number,
           'com.acme.p' || p AS addon_key, 'Product ' || p AS addon_name,
           (['cloud', 'server', 'datacenter'])[cust % 3 + 1] AS hosting,
           sale_date, sale_type, purchase_price, purchase_price * CAST(0.75 AS DOUBLE) AS vendor_amount,
           CASE WHEN cust % 2 = 0 THEN 'Annual' ELSE 'Monthly' END AS billing_period,
           'Tier ' || (cust % 4) AS tier, sale_date AS maintenance_start_date,
           CAST(CASE WHEN cust % 2 = 0 THEN sale_date + INTERVAL 12 MONTH
                     ELSE sale_date + INTERVAL 1 MONTH END AS DATE) AS maintenance_end_date,
           (['direct', 'partner'])[order_id % 2 + 1] AS sale_channel,
           'Host ' || p AS parent_product_name,
           (['standard', 'premium'])[cust % 2 + 1] AS parent_product_edition,
           CASE WHEN order_id % 3 = 0 THEN 5.0 ELSE 0.0 END AS loyalty_discount,
           CASE WHEN order_id % 5 = 0 THEN 2.5 ELSE 0.0 END AS marketplace_promotion_discount,
           0.0 AS expert_discount,
           purchase_price = 0 AS is_zero_value, purchase_price < 0 AS is_refund,
           CAST(sale_date + INTERVAL 1 DAY AS TIMESTAMP) AS extracted_at,
           TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
    FROM priced"""

TABLES["directory"] = """
    SELECT c_custkey AS company_id, c_name AS company_name, n_name AS country, r_name AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

TABLES["sale_groups"] = """
    SELECT cust, p, min(sale_date) AS first_date, max(sale_date) AS last_date FROM sold GROUP BY cust, p"""

TABLES["license_kinds"] = """
    SELECT *, cust * 100 + p AS id, 'commercial' AS kind FROM sale_groups
    UNION ALL SELECT *, cust * 100 + p + 10, 'converted' FROM sale_groups WHERE (cust + p) % 3 = 0
    UNION ALL SELECT *, cust * 100 + p + 20, 'other' FROM sale_groups WHERE (cust + p) % 4 = 1"""

TABLES["lic"] = """
    SELECT id AS addon_license_id, 'L' || id AS license_id,
           CASE WHEN cust % 3 <> 0 THEN 'E' || cust END AS app_entitlement_number,
           CAST(cust AS VARCHAR) AS host_license_id,
           CASE WHEN cust % 5 <> 0 THEN 'HE' || cust END AS host_entitlement_number,
           CASE WHEN cust % 4 <> 0 THEN 'c-' || cust END AS cloud_id,
           CASE WHEN cust % 4 <> 0 THEN 'site' || cust || '.example.net' END AS cloud_site_hostname,
           'com.acme.p' || p AS addon_key, 'Product ' || p AS addon_name,
           (['cloud', 'server', 'datacenter'])[cust % 3 + 1] AS hosting,
           CAST(last_date + INTERVAL 1 DAY AS TIMESTAMP) AS last_updated,
           CASE WHEN kind = 'commercial' THEN 'commercial' ELSE 'evaluation' END AS license_type,
           CAST(CASE WHEN kind = 'commercial' THEN first_date
                     ELSE first_date - INTERVAL 30 DAY END AS DATE) AS maintenance_start_date,
           CAST(CASE kind WHEN 'commercial' THEN last_date + INTERVAL 12 MONTH WHEN 'converted' THEN first_date
                ELSE first_date + INTERVAL 60 DAY END AS DATE) AS maintenance_end_date,
           (['active', 'active', 'active', 'active', 'expired', 'cancelled'])[id % 6 + 1] AS status,
           'Tier ' || (cust % 4) AS tier,
           company_name || ([' GmbH', ', Inc.', ''])[cust % 3 + 1] AS company, country, region,
           'admin' || cust || '@example.com' AS tech_contact_email, 'Admin ' || cust AS tech_contact_name,
           CASE WHEN kind <> 'commercial' THEN '10-50' END AS evaluation_opportunity_size,
           CASE WHEN from_trial THEN cust * 100 + p + 10 END AS evaluation_license,
           CASE WHEN from_trial THEN CAST(cust % 30 AS DOUBLE) END AS days_to_convert_eval,
           CASE WHEN from_trial THEN CAST(first_date - INTERVAL 30 DAY AS DATE) END AS evaluation_start_date,
           CASE WHEN from_trial THEN first_date END AS evaluation_end_date,
           CASE WHEN from_trial THEN first_date END AS evaluation_sale_date,
           kind <> 'commercial' AS is_evaluation, id % 6 < 4 AS is_active, from_trial AS is_converted,
           CAST(last_date + INTERVAL 2 DAY AS TIMESTAMP) AS extracted_at,
           TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
    FROM (SELECT *, kind = 'commercial' AND (cust + p) % 3 = 0 AS from_trial FROM license_kinds)
    LEFT JOIN directory ON company_id = cust - CASE WHEN cust % 10 = 9 THEN 1 ELSE 0 END"""

TABLES["ev"] = """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_id % 300 = 1 THEN 'automated_test_run' ELSE event_type END AS event_type,
           ts AS event_time,
           CASE WHEN event_id % 12 <> 0 THEN 'u' || user_id END AS user_id,
           CASE WHEN event_id % 250 = 0 THEN 'bot-automation-001' ELSE 'dev-' || user_id END AS device_id,
           (['web', 'ios', 'android'])[event_id % 3 + 1] AS platform,
           (['client', 'server'])[event_id % 2 + 1] AS event_source,
           'p' || (event_id % 5 + 1) AS product,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS event_property_k,
           CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'Unknown Org ' || (event_id % 100)
                WHEN event_id % 2 = 0 THEN company_name || ' Ltd' ELSE company_name END AS user_property_company,
           CASE WHEN event_id % 4 = 3 THEN 'pro' END AS user_property_plan,
           CASE WHEN event_id % 3 = 2 THEN 'gold' END AS user_property_tier,
           CAST(user_id * 100 + day(ts) AS BIGINT) AS session_id,
           lower(country) AS country, lower(region) AS region,
           event_id % 12 = 0 AS is_anonymous, event_id % 250 = 0 AS is_bot, event_id % 300 = 1 AS is_test_event,
           CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS extracted_at,
           CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) + INTERVAL 1 HOUR AS loaded_at
    FROM events LEFT JOIN directory ON company_id = user_id - CASE WHEN user_id % 10 = 9 THEN 1 ELSE 0 END"""

TABLES["iso"] = "SELECT lower(n_name) AS country_name, 'N' || n_nationkey AS iso_code FROM nation WHERE n_nationkey % 5 <> 0"

TABLES["lic_iso"] = """
    SELECT lic.*, lower(coalesce(iso_code, lower(trim(country)))) AS country_iso
    FROM lic LEFT JOIN iso ON lower(trim(country)) = country_name"""

TABLES["hub"] = f"""
    SELECT host_license_id AS instance_id, cloud_id, host_license_id, hosting, country_iso,
           {company_key('company', 'country_iso')} AS company_key, has_active_license,
           product_count, product_count_active, products, last_updated
    FROM (SELECT host_license_id, max(cloud_id) AS cloud_id, max(hosting) AS hosting, max(company) AS company,
                 max(country_iso) AS country_iso, bool_or(is_active) AS has_active_license,
                 count(DISTINCT addon_key) AS product_count,
                 count(DISTINCT addon_key) FILTER (WHERE is_active) AS product_count_active,
                 string_agg(DISTINCT addon_key, ',' ORDER BY addon_key) AS products,
                 max(last_updated) AS last_updated
          FROM lic_iso GROUP BY host_license_id)"""

TABLES["keyed"] = f"""
    SELECT *, {month('event_time')} AS event_month,
           {company_key('user_property_company', 'country_iso')} AS company_key
    FROM (SELECT ev.*, lower(coalesce(iso_code, lower(trim(country)))) AS country_iso
          FROM ev LEFT JOIN iso ON lower(trim(country)) = country_name
          WHERE NOT is_bot AND NOT is_test_event)"""

TABLES["bridged"] = """
    SELECT keyed.*, hub.instance_id, hub.instance_id IS NOT NULL AS is_matched
    FROM keyed LEFT JOIN hub ON keyed.company_key = hub.company_key"""

TABLES["usage"] = """
    SELECT event_month, product, event_type, company_key, instance_id, is_matched,
           count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
           count(DISTINCT session_id) AS unique_sessions,
           count(DISTINCT device_id) FILTER (WHERE is_anonymous) AS anonymous_device_count
    FROM bridged GROUP BY ALL"""

TABLES["mrr_plain"] = f"""
    SELECT tx.*, host_license_id AS instance_id, host_license_id, cloud_id, company, country,
           {month('sale_date')} AS sale_month,
           {month('maintenance_end_date + INTERVAL 1 DAY')} AS expected_next_renewal_month,
           CASE WHEN billing_period = 'Monthly' THEN purchase_price ELSE purchase_price / 12 END AS mrr
    FROM tx LEFT JOIN (SELECT addon_license_id, host_license_id, cloud_id, company, country FROM lic)
      USING (addon_license_id)
    WHERE sale_type IN ('NEW', 'RENEWAL') AND NOT is_refund"""

TABLES["mrr_lagged"] = """
    SELECT *, lag(sale_month) OVER (PARTITION BY instance_id, addon_key ORDER BY sale_date, transaction_id)
                AS prev_renewal_month
    FROM mrr_plain"""

TABLES["mrr_rows"] = f"""
    SELECT *, sale_type = 'RENEWAL' AND prev_renewal_month IS NOT NULL
              AND {month_index('sale_month')} - {month_index('prev_renewal_month')}
                  > CASE WHEN billing_period = 'Annual' THEN 13 ELSE 1 END AS is_renewal_gap
    FROM mrr_lagged"""

TABLES["prior"] = """
    SELECT *, lag(mrr) OVER (PARTITION BY instance_id, addon_key, billing_period
                             ORDER BY sale_date, transaction_id) AS prior_mrr
    FROM mrr_rows WHERE instance_id IS NOT NULL"""

TABLES["moved"] = """
    SELECT *, CASE WHEN sale_type = 'NEW' THEN 'new' WHEN is_renewal_gap THEN 'reactivation'
                   WHEN prior_mrr IS NULL OR mrr = prior_mrr THEN 'renewal'
                   WHEN mrr > prior_mrr THEN 'expansion' ELSE 'contraction' END AS mrr_movement_type
    FROM prior"""

TABLES["first_sales"] = """
    SELECT addon_license_id, min(sale_date) AS first_sale_date, sum(purchase_price) AS total_arr
    FROM tx WHERE sale_type = 'NEW' AND NOT is_refund GROUP BY addon_license_id"""

TABLES["trials"] = f"""
    SELECT e.addon_license_id AS eval_license_id, e.addon_key, e.host_license_id AS instance_id, e.company,
           e.country, e.hosting, e.tier AS eval_tier, e.maintenance_start_date AS eval_start_date,
           e.maintenance_end_date AS eval_end_date, c.addon_license_id AS commercial_license_id,
           c.maintenance_start_date AS commercial_start_date, c.tier AS commercial_tier,
           c.days_to_convert_eval, f.first_sale_date, f.total_arr AS converted_arr,
           CASE WHEN c.addon_license_id IS NOT NULL THEN 'converted'
                WHEN e.maintenance_end_date < DATE '2024-03-01' THEN 'expired' ELSE 'active_trial' END AS trial_outcome,
           c.addon_license_id IS NOT NULL AS is_converted,
           e.maintenance_end_date < DATE '2024-03-01' AND c.addon_license_id IS NULL AS is_expired_no_convert,
           {month('e.maintenance_start_date')} AS eval_cohort_month
    FROM lic e LEFT JOIN lic c ON c.evaluation_license = e.addon_license_id
    LEFT JOIN first_sales f ON f.addon_license_id = c.addon_license_id
    WHERE e.is_evaluation"""

TABLES["annual"] = f"""
    SELECT host_license_id AS instance_id, tx.addon_key, sale_type, {month('sale_date')} AS txn_month, purchase_price
    FROM tx JOIN lic USING (addon_license_id)
    WHERE billing_period = 'Annual' AND sale_type IN ('NEW', 'RENEWAL') AND NOT is_refund
      AND host_license_id IS NOT NULL"""

TABLES["acquired"] = """
    SELECT instance_id, addon_key, min(txn_month) AS cohort_month FROM annual
    WHERE sale_type = 'NEW' GROUP BY instance_id, addon_key"""

TABLES["spread"] = f"""
    SELECT cohort_month, addon_key, instance_id, txn_month,
           CAST(cohort_month + to_months(CAST(k AS INTEGER)) AS DATE) AS revenue_month,
           CAST(purchase_price AS DECIMAL(18, 4)) AS amount
    FROM annual JOIN acquired USING (instance_id, addon_key), range(92) AS periods(k)
    WHERE k >= {month_index('txn_month')} - {month_index('cohort_month')}
      AND k < {month_index('txn_month')} - {month_index('cohort_month')} + 12"""

TABLES["churn"] = """
    SELECT *, lag(total_mrr) OVER w AS beginning_mrr, lag(total_logos) OVER w AS beginning_logos
    FROM (SELECT sale_month, addon_key, addon_name, billing_period,
                 coalesce(sum(mrr) FILTER (WHERE mrr_movement_type = 'new'), 0) AS new_mrr,
                 coalesce(sum(mrr) FILTER (WHERE mrr_movement_type = 'renewal'), 0) AS renewal_mrr,
                 coalesce(sum(mrr) FILTER (WHERE mrr_movement_type = 'expansion'), 0) AS expansion_mrr,
                 coalesce(sum(mrr) FILTER (WHERE mrr_movement_type = 'contraction'), 0) AS contraction_mrr,
                 coalesce(sum(mrr) FILTER (WHERE mrr_movement_type = 'reactivation'), 0) AS reactivation_mrr,
                 sum(mrr) AS total_mrr,
                 count(DISTINCT instance_id) FILTER (WHERE mrr_movement_type = 'new') AS new_logos,
                 count(DISTINCT instance_id) FILTER (WHERE mrr_movement_type = 'renewal') AS renewing_logos,
                 count(DISTINCT instance_id) AS total_logos,
                 count(DISTINCT instance_id) FILTER (WHERE is_zero_value) AS zero_value_logos
          FROM moved GROUP BY ALL)
    WINDOW w AS (PARTITION BY addon_key, billing_period ORDER BY sale_month, addon_name)"""

TABLES["active"] = """
    SELECT *, count(*) OVER (PARTITION BY sale_month, addon_key) AS active_workspaces_per_product_month,
           count(DISTINCT instance_id) OVER (PARTITION BY sale_month) AS total_active_workspaces_month
    FROM (SELECT sale_month, addon_key, addon_name, hosting, instance_id, company, country,
                 sum(mrr) AS monthly_mrr, count(transaction_id) AS transaction_count,
                 bool_or(is_zero_value) AS has_zero_value_tx
          FROM mrr_rows WHERE instance_id IS NOT NULL GROUP BY ALL)"""

TABLES["conversion"] = """
    SELECT eval_cohort_month, addon_key, count(*) AS total_trials,
           count(*) FILTER (WHERE is_converted) AS converted_count,
           count(*) FILTER (WHERE is_expired_no_convert) AS expired_count,
           count(*) FILTER (WHERE trial_outcome = 'active_trial') AS active_trial_count,
           avg(days_to_convert_eval) FILTER (WHERE is_converted) AS avg_days_to_convert,
           median(days_to_convert_eval) FILTER (WHERE is_converted) AS median_days_to_convert,
           coalesce(sum(converted_arr) FILTER (WHERE is_converted), 0) AS cohort_converted_arr
    FROM trials GROUP BY ALL"""

TABLES["trial_usage"] = """
    SELECT usage.*, coalesce(trial_outcome, 'non_trial') AS customer_cohort
    FROM usage LEFT JOIN trials
      ON usage.instance_id = trials.instance_id AND usage.product = replace(trials.addon_key, 'com.acme.', '')
    WHERE usage.instance_id IS NOT NULL"""

TABLES["adoption"] = """
    SELECT event_month, product, event_type, customer_cohort,
           count(DISTINCT instance_id) AS workspace_count, sum(event_count) AS total_events,
           sum(unique_users) AS total_unique_users, sum(unique_sessions) AS total_unique_sessions,
           avg(event_count) AS avg_events_per_workspace, avg(unique_users) AS avg_users_per_workspace,
           count(DISTINCT instance_id) FILTER (WHERE event_count > 0) / count(DISTINCT instance_id)
             AS feature_adoption_rate
    FROM trial_usage GROUP BY ALL"""

TABLES["license_side"] = """
    SELECT host_license_id AS instance_id, company, country, bool_or(is_active) AS has_active_license,
           count(DISTINCT addon_key) AS product_count, max(maintenance_end_date) AS latest_maintenance_end,
           CAST(date_diff('day', max(maintenance_end_date), DATE '2024-03-01') AS INTEGER) AS days_since_maintenance_end
    FROM lic GROUP BY ALL"""

TABLES["revenue_side"] = """
    SELECT instance_id, sum(mrr) AS current_mrr, max(sale_month) AS last_transaction_month
    FROM mrr_rows WHERE sale_month = (SELECT max(sale_month) FROM mrr_rows) AND instance_id IS NOT NULL GROUP BY instance_id"""

TABLES["median_side"] = "SELECT median(current_mrr) AS med_mrr FROM revenue_side WHERE current_mrr > 0"

TABLES["usage_side"] = """
    SELECT instance_id, CAST(sum(event_count) AS BIGINT) AS events_90d,
           count(DISTINCT event_type) AS distinct_features_90d,
           CAST(sum(unique_users) AS BIGINT) AS unique_users_90d, max(event_month) AS last_active_month
    FROM usage WHERE event_month >= DATE '2023-12-01' AND is_matched GROUP BY instance_id"""

TABLES["health"] = """
    SELECT instance_id, company, country, product_count, has_active_license, latest_maintenance_end,
           days_since_maintenance_end, coalesce(current_mrr, 0) AS current_mrr, last_transaction_month,
           coalesce(events_90d, 0) AS events_90d, coalesce(distinct_features_90d, 0) AS distinct_features_90d,
           coalesce(unique_users_90d, 0) AS unique_users_90d, last_active_month,
           CASE WHEN has_active_license THEN 100 WHEN days_since_maintenance_end <= 30 THEN 50 ELSE 0 END AS license_score,
           CASE WHEN coalesce(current_mrr, 0) = 0 THEN 0 WHEN current_mrr >= 2 * med_mrr THEN 100
                WHEN current_mrr >= med_mrr THEN 75 WHEN current_mrr >= med_mrr / 2 THEN 50 ELSE 25 END AS revenue_score,
           CASE WHEN distinct_features_90d >= 5 THEN 100 WHEN distinct_features_90d >= 3 THEN 75
                WHEN distinct_features_90d >= 1 THEN 50 ELSE 0 END AS engagement_score
    FROM license_side LEFT JOIN revenue_side USING (instance_id) LEFT JOIN usage_side USING (instance_id), median_side"""


def needed(sql: str) -> list[str]:
    """Names of the tables a statement uses, each after the ones it uses."""
    order: list[str] = []

    def visit(statement: str) -> None:
        words = set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", statement)))
        for name in TABLES:
            if name in words and name not in order and TABLES[name] is not statement:
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def with_tables(sql: str) -> str:
    parts = [f"{name} AS ({TABLES[name]}\n)" for name in needed(sql)]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
