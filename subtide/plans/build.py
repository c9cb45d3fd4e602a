"""The whole chain: files to landing, staging, intermediate tables and marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from subtide.params import ReportParams
from subtide.plans import customers, marts, subscriptions
from subtide.plans.quality import ContractReport, key_failures, observed
from subtide.plans.staging import stage_landed
from subtide.sources.keyed_table import KeyedTable
from subtide.sources.layers import PLAIN, Layout, write_table
from subtide.sources.schemas import CONTRACTS, EVENTS, KEYS, LICENSES, TRANSACTIONS
from subtide.sources.seeds import suffix_list
from subtide.streaming.landing import current_generation, land_files, landed, last_load

# Folder of every source under the raw folder, and its cleaned table.
SOURCES = {
    "marketplace_licenses": LICENSES,
    "marketplace_transactions": TRANSACTIONS,
    "amplitude_events": EVENTS,
}


@dataclass(frozen=True)
class Warehouse:
    """Where the tables live.

    ``co_located`` lays out the tables that are joined by license in buckets of
    it, which costs one exchange when they are written and saves one in each
    join; switch it off where one license holds a large part of the sales.
    ``buckets`` and ``files_per_bucket`` size the three cleaned tables;
    ``max_files_per_trigger`` cuts a large load into micro-batches, which are
    what a failed load repeats.
    """

    spark: SparkSession
    root: str
    buckets: int = 64
    files_per_bucket: int = 1
    max_files_per_trigger: int | None = None
    co_located: bool = True

    def by_license(self, column: str) -> Layout:
        return Layout(bucket_by=column, buckets=self.buckets) if self.co_located else PLAIN

    def landing(self, source: str) -> str:
        return f"{self.root}/RAW/{source}_raw"

    def staging(self, table: str) -> KeyedTable:
        path = f"{self.root}/STAGING/{table}"
        return KeyedTable(self.spark, path, KEYS[table], self.buckets, self.files_per_bucket)


def refresh_staging(
    warehouse: Warehouse, source: str, files: str, full_refresh: bool = False, report: ContractReport | None = None
) -> DataFrame:
    """Load new files of a source and upsert their rows into its cleaned table.

    The contract's required and accepted values are counted by the job that writes
    the new rows, and go to ``report`` before the rows are committed.
    """
    table = SOURCES[source]
    report = report or ContractReport()
    staging = warehouse.staging(table)
    landing = warehouse.landing(source)
    land_files(
        warehouse.spark,
        files,
        landing,
        full_refresh=full_refresh,
        max_files_per_trigger=warehouse.max_files_per_trigger,
    )
    # The mark is the last load that was taken over, not one of the rows that survived deduplication.
    position = (current_generation(warehouse.spark, landing), last_load(warehouse.spark, landing))
    if full_refresh:
        rows = landed(warehouse.spark, landing, loads=(-1, position[1]))
        batch = observed(stage_landed(rows, table), CONTRACTS[table])
        staging.overwrite(batch.rows, f"refresh-{position[0]}", position, lambda: report.add(batch.failures()))
    else:
        done = staging.position()
        taken = done[1] if done is not None and done[0] == position[0] else -1
        rows = landed(warehouse.spark, landing, loads=(taken, position[1]))
        batch = observed(stage_landed(rows, table), CONTRACTS[table])
        staging.upsert(batch.rows, position=position, check=lambda: report.add(batch.failures()))
    return staging.read()


def build_models(
    warehouse: Warehouse,
    staged: dict[str, DataFrame],
    countries: DataFrame,
    suffixes: DataFrame,
    params: ReportParams,
) -> dict[str, DataFrame]:
    """Rebuild the intermediate tables and marts from cleaned tables.

    Every table is written before the next step reads it, so shared steps are
    computed once and each step starts from files. Tables that are joined by
    license lie in buckets of it, those that are read by month in folders of it.
    """
    events = staged[EVENTS]
    built: dict[str, DataFrame] = {}

    def keep(layer: str, table: str, df: DataFrame, layout: Layout = PLAIN) -> DataFrame:
        built[table] = write_table(df, warehouse.root, layer, table, layout)
        return built[table]

    by_license = warehouse.by_license("addon_license_id")
    licenses, transactions = (
        keep("staging", table, staged[table], by_license) if warehouse.co_located else staged[table]
        for table in (LICENSES, TRANSACTIONS)
    )

    country_list = keep("reference", "dim_country_codes", countries)
    suffix_words = suffix_list(keep("reference", "dim_legal_suffixes", suffixes))

    hub = keep("intermediate", "int_customers", customers.customers(licenses, country_list, suffix_words))
    keyed = customers.keyed_events(events, country_list, suffix_words)
    usage = keep("intermediate", "int_feature_usage", customers.feature_usage(keyed, hub), Layout(partition_by="event_month"))
    mrr = keep(
        "intermediate", "int_monthly_mrr", subscriptions.monthly_mrr(transactions, licenses), Layout(partition_by="sale_month")
    )
    conversions = None
    if warehouse.co_located:
        found = subscriptions.trial_conversions(licenses, transactions)
        conversions = keep("intermediate", "int_trial_conversions", found, warehouse.by_license("eval_license_id"))
    trials = keep(
        "intermediate",
        "int_trial_lifecycle",
        subscriptions.trial_lifecycle(licenses, transactions, params, conversions),
    )
    keep(
        "intermediate",
        "int_annual_mrr_cohort",
        subscriptions.annual_cohort_matrix(transactions, licenses, params),
    )

    keep("marts", "mart_active_customers", marts.active_customers(mrr))
    keep("marts", "mart_trial_conversion", marts.trial_conversion(trials, params))
    keep("marts", "mart_mrr_churn", marts.mrr_churn(mrr))
    keep("marts", "mart_feature_adoption", marts.feature_adoption(usage, trials, params))
    keep("marts", "mart_customer_health", marts.customer_health(licenses, mrr, usage, params))
    return built


def run(
    warehouse: Warehouse,
    raw_root: str,
    countries: DataFrame,
    suffixes: DataFrame,
    params: ReportParams,
    full_refresh: bool = False,
    stop_on_violations: bool = False,
) -> dict[str, DataFrame]:
    """Load ``raw_root/raw/<source>/`` and rebuild everything behind it.

    ``contract_failures`` of the result holds the checks that failed: required
    and accepted values among the rows of this load, unique keys and references
    over the whole tables. With ``stop_on_violations`` a load that breaks its
    contract raises ``ContractViolation`` and commits nothing, and broken keys or
    references raise before any model is rebuilt.
    """
    report = ContractReport(stop_on_violations)
    staged = {
        table: refresh_staging(warehouse, source, f"{raw_root}/raw/{source}/", full_refresh, report)
        for source, table in SOURCES.items()
    }
    for table, df in staged.items():
        df.createOrReplaceTempView(table)
    report.add(key_failures(staged, CONTRACTS))
    built = build_models(warehouse, staged, countries, suffixes, params)
    return {**staged, **built, "contract_failures": report.frame(warehouse.spark)}
