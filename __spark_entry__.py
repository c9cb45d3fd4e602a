"""Registered queries over the order, customer and event tables.

The subscription sources are derived from those tables as FIXTURES.md says.
Dates and times are returned as text and amounts rounded to four decimals, so
that results can be compared with those of another database.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import cached_property, lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oracle.queries import oracle_sql as _oracle_sql
from subtide.functions.dates import months_apart
from subtide.operators.latest import latest_per_key
from subtide.operators.lookups import orphans, with_country_code
from subtide.operators.median import positive_median
from subtide.plans import customers, marts, quality, reports, staging, subscriptions
from subtide.plans.build import Warehouse, refresh_staging
from subtide.plans.staging import CLEAN, stage_landed
from subtide.session import materialized, new_scratch_folder, prepare_session
from subtide.sources import star_tables
from subtide.sources.keyed_table import KeyedTable
from subtide.sources.layers import Layout, write_table
from subtide.sources.schemas import CONTRACTS, EVENTS, LICENSES, TRANSACTIONS, Contract
from subtide.sources.seeds import LEGAL_SUFFIXES
from subtide.streaming.landing import land_files, landed, newer_than, parse_lines, read_lines

PARAMS = star_tables.PARAMS


class Feed:
    """Cleaned sources and shared models of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, table: str, redelivered: bool = False) -> DataFrame:
        rows = star_tables.RAW[table](self.spark, self.sf_dir)
        return star_tables.redelivered(rows, table) if redelivered else rows

    def delivered(self, table: str) -> DataFrame:
        """Landing table, parsed from the JSON lines of a delivery with copies."""
        lines = materialized(star_tables.envelopes(self.raw(table, redelivered=True), table), "lines")
        return materialized(lines.select(F.parse_json("value").alias("raw_data"), "loaded_at"), "landing")

    @cached_property
    def licenses(self) -> DataFrame:
        return CLEAN[LICENSES](self.raw(LICENSES))

    @cached_property
    def transactions(self) -> DataFrame:
        return CLEAN[TRANSACTIONS](self.raw(TRANSACTIONS))

    @cached_property
    def events(self) -> DataFrame:
        return CLEAN[EVENTS](self.raw(EVENTS))

    @cached_property
    def countries(self) -> DataFrame:
        return star_tables.countries(self.spark, self.sf_dir)

    @cached_property
    def hub(self) -> DataFrame:
        return customers.customers(self.licenses, self.countries, LEGAL_SUFFIXES)

    @cached_property
    def keyed(self) -> DataFrame:
        return customers.keyed_events(self.events, self.countries, LEGAL_SUFFIXES)

    @cached_property
    def usage(self) -> DataFrame:
        return customers.feature_usage(self.keyed, self.hub)

    @cached_property
    def mrr(self) -> DataFrame:
        return subscriptions.monthly_mrr(self.transactions, self.licenses)

    @cached_property
    def trials(self) -> DataFrame:
        return subscriptions.trial_lifecycle(self.licenses, self.transactions, PARAMS)

    @cached_property
    def churn(self) -> DataFrame:
        return marts.mrr_churn(self.mrr)

    @cached_property
    def adoption(self) -> DataFrame:
        return marts.feature_adoption(self.usage, self.trials, PARAMS)

    @cached_property
    def written(self) -> "Feed":
        """The same feed over written layer tables: by license in buckets, by month in folders."""
        return WrittenFeed(self)


class WrittenFeed(Feed):
    """Tables of a feed that are written once, when first used."""

    def __init__(self, feed: Feed):
        super().__init__(feed.spark, feed.sf_dir)
        self.feed = feed
        self.root = new_scratch_folder(feed.spark, "layers")

    def _keep(self, layer: str, table: str, df: DataFrame, layout: Layout) -> DataFrame:
        return write_table(df, self.root, layer, table, layout)

    @cached_property
    def licenses(self) -> DataFrame:
        return self._keep("staging", LICENSES, self.feed.licenses, Layout(bucket_by="addon_license_id", buckets=8))

    @cached_property
    def transactions(self) -> DataFrame:
        return self._keep("staging", TRANSACTIONS, self.feed.transactions, Layout(bucket_by="addon_license_id", buckets=8))

    @cached_property
    def mrr(self) -> DataFrame:
        rows = subscriptions.monthly_mrr(self.transactions, self.licenses)
        return self._keep("intermediate", "int_monthly_mrr", rows, Layout(partition_by="sale_month"))

    @cached_property
    def usage(self) -> DataFrame:
        rows = customers.feature_usage(self.keyed, self.hub)
        return self._keep("intermediate", "int_feature_usage", rows, Layout(partition_by="event_month"))

    @cached_property
    def trials(self) -> DataFrame:
        found = subscriptions.trial_conversions(self.licenses, self.transactions)
        layout = Layout(bucket_by="eval_license_id", buckets=8)
        conversions = self._keep("intermediate", "int_trial_conversions", found, layout)
        return subscriptions.trial_lifecycle(self.licenses, self.transactions, PARAMS, conversions)


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DoubleType, T.DecimalType)):
            column = F.round(column.cast("double"), 4)
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def exact_sum(amount: Column) -> Column:
    """Sum of a whole table's amounts that no order of its rows can change."""
    return F.sum(amount.cast(subscriptions.MONEY)).cast("double")


# --- loading -----------------------------------------------------------------


def _is_gzip() -> Column:
    return F.col("file_name").endswith(".gz").alias("is_gzip")


def _delivery(feed: Feed) -> str:
    """Transactions with copies and cut-off lines, as gzip files of JSON lines."""
    rows = feed.raw(TRANSACTIONS)
    lines = star_tables.envelopes(star_tables.redelivered(rows, TRANSACTIONS), TRANSACTIONS)
    all_lines = lines.select("value").unionByName(star_tables.broken_lines(rows))
    return star_tables.deliver(all_lines, new_scratch_folder(feed.spark, "delivery"))


def raw_landing(feed: Feed) -> DataFrame:
    parsed = parse_lines(read_lines(feed.spark, _delivery(feed)), datetime(2024, 3, 1))
    field = lambda name, kind: F.variant_get("raw_data", f"$.payload.{name}", kind).alias(name)
    return parsed.where("valid").select(
        field("transaction_id", "string"),
        field("sale_date", "date"),
        F.upper(field("sale_type", "string")).alias("sale_type"),
        field("purchase_price", "double"),
        F.variant_get("raw_data", "$.metadata.extracted_at", "timestamp").alias("extracted_at"),
        _is_gzip(),
    )


def raw_quarantine(feed: Feed) -> DataFrame:
    parsed = parse_lines(read_lines(feed.spark, _delivery(feed)), datetime(2024, 3, 1))
    return parsed.where("NOT valid").select("raw_text", _is_gzip())


def _two_deliveries(feed: Feed, load: Callable[[str], None]) -> None:
    """Deliver older sales, load, deliver newer sales, load, and load once more."""
    files = new_scratch_folder(feed.spark, "delivery")
    rows = feed.raw(TRANSACTIONS)
    for part in (F.col("sale_date") < F.lit(date(2022, 1, 1)), F.col("sale_date") >= F.lit(date(2022, 1, 1))):
        star_tables.deliver(star_tables.envelopes(rows.where(part), TRANSACTIONS), files)
        load(files)
    load(files)


def incremental_ingest(feed: Feed) -> DataFrame:
    landing = new_scratch_folder(feed.spark, "landing")
    _two_deliveries(feed, lambda files: land_files(feed.spark, files, landing))
    loads = (
        landed(feed.spark, landing)
        .groupBy("loaded_at")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            exact_sum(F.variant_get("raw_data", "$.payload.purchase_price", "double")).alias("price_sum"),
        )
    )
    # One row per load is left.
    order = F.row_number().over(Window.orderBy("loaded_at")).cast("int")
    return loads.select(order.alias("load_no"), "n_rows", "price_sum")


def full_refresh(feed: Feed) -> DataFrame:
    warehouse = Warehouse(feed.spark, new_scratch_folder(feed.spark, "warehouse"), buckets=8)
    source = "marketplace_transactions"
    files = []

    def load(folder: str) -> None:
        files.append(folder)
        refresh_staging(warehouse, source, folder)

    _two_deliveries(feed, load)
    staged = refresh_staging(warehouse, source, files[-1], full_refresh=True)
    return staged.groupBy("sale_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        exact_sum(F.col("purchase_price")).alias("price_sum"),
        exact_sum(F.col("vendor_amount")).alias("vendor_sum"),
    )


def high_water_mark(feed: Feed) -> DataFrame:
    target = feed.events.where(F.col("event_time") < F.lit(datetime(2024, 1, 16)).cast("timestamp"))
    mark = target.agg(F.max("loaded_at")).first()[0]
    return newer_than(feed.events, mark).select("event_id", "loaded_at")


def upsert_by_key(feed: Feed) -> DataFrame:
    """Older sales first; then the newer ones together with corrected refunds."""
    table = KeyedTable(feed.spark, new_scratch_folder(feed.spark, "upsert"), "transaction_id", buckets=8)
    is_old = F.col("sale_date") < F.lit(date(2022, 1, 1))
    refund = F.col("sale_type") == "REFUND"
    corrected = F.when(refund, 0.0).otherwise(F.col("vendor_amount"))
    table.upsert(feed.transactions.where(is_old), "load-1")
    second = feed.transactions.where(~is_old | refund).withColumn("vendor_amount", corrected)
    table.upsert(second, "load-2")
    table.upsert(second, "load-2")
    return table.read().select("transaction_id", "sale_date", "sale_type", "purchase_price", "vendor_amount")


# --- cleaning ----------------------------------------------------------------


def stg_events(feed: Feed) -> DataFrame:
    staged = stage_landed(feed.delivered(EVENTS), EVENTS)
    number = F.variant_get("event_properties", "$.k", "bigint").alias("event_property_k")
    return staged.select(*(c for c in staged.columns if c != "event_properties"), number)


def newest_licenses(feed: Feed) -> DataFrame:
    kept = latest_per_key(feed.raw(LICENSES, redelivered=True), ["addon_license_id"], staging.NEWEST[LICENSES])
    return CLEAN[LICENSES](kept).select("addon_license_id", "last_updated", "status")


# --- single operators --------------------------------------------------------


def company_keys(feed: Feed) -> DataFrame:
    real = feed.events.where(~F.col("is_bot") & ~F.col("is_test_event"))
    coded = with_country_code(real, feed.countries)
    key = customers.company_key(F.col("user_property_company"), F.col("country_iso"), LEGAL_SUFFIXES)
    return coded.select(
        F.col("user_property_company").alias("company"), "country_iso", key.alias("company_key")
    ).distinct()


def iso_country(feed: Feed) -> DataFrame:
    coded = with_country_code(feed.licenses, feed.countries)
    return coded.groupBy("country", "country_iso").agg(F.count(F.lit(1)).alias("n_licenses"))


def company_bridge(feed: Feed) -> DataFrame:
    joined = customers.bridge(feed.keyed, feed.hub, spread_by="event_id")
    return joined.select("event_id", "company_key", "instance_id", "is_matched")


def renewal_gap(feed: Feed) -> DataFrame:
    gap = months_apart(F.col("prev_renewal_month"), F.col("sale_month")).cast("bigint")
    grain = ["billing_period", "sale_type", gap.alias("gap"), "is_renewal_gap"]
    return feed.mrr.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_rows"))


def trial_outcome(feed: Feed) -> DataFrame:
    grain = ["hosting", "trial_outcome", "is_converted", "is_expired_no_convert"]
    return feed.trials.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_trials"))


def month_spread(feed: Feed) -> DataFrame:
    return subscriptions.cohort_spread(feed.transactions, feed.licenses, PARAMS).drop("new_instances")


def usage_by_trial(feed: Feed) -> DataFrame:
    return marts.usage_by_trial(feed.usage, feed.trials, PARAMS).select(
        "event_month", "product", "event_type", "company_key", "instance_id", "customer_cohort",
        "n_trials", "event_count",
    )


def trial_conversion_literal(feed: Feed) -> DataFrame:
    return marts.trial_conversion(feed.trials, replace(PARAMS, literal=True))


def median_mrr(feed: Feed) -> DataFrame:
    return positive_median(marts.revenue_signal(feed.mrr), "current_mrr", "med_mrr")


def active_report(feed: Feed) -> DataFrame:
    return reports.active_customers_report(marts.active_customers(feed.mrr), PARAMS)


def conversion_report(feed: Feed) -> DataFrame:
    return reports.trial_conversion_report(marts.trial_conversion(feed.trials, PARAMS), PARAMS)


# --- data checks -------------------------------------------------------------


def _each_contract(check: Callable, frames: dict[str, DataFrame], kind: str) -> DataFrame:
    parts = [check(frames[name], CONTRACTS[name]) for name in frames if getattr(CONTRACTS[name], kind)]
    return reduce(DataFrame.unionByName, parts)


def _cleaned(feed: Feed) -> dict[str, DataFrame]:
    return {LICENSES: feed.licenses, TRANSACTIONS: feed.transactions, EVENTS: feed.events}


def _raw(feed: Feed, redelivered: bool) -> dict[str, DataFrame]:
    return {name: feed.raw(name, redelivered) for name in star_tables.RAW}


def fk_violations(feed: Feed) -> DataFrame:
    """References of transactions, and company keys of events without a workspace."""
    sales = quality.reference_failures(feed.transactions, CONTRACTS[TRANSACTIONS], _cleaned(feed))
    bridge = orphans(feed.keyed, "company_key", feed.hub, "company_key").select(
        F.lit(EVENTS).alias("table_name"), F.lit("company_key").alias("column_name"), "value", "n_records"
    )
    return sales.unionByName(bridge)


def contract_summary(feed: Feed) -> DataFrame:
    frames = {name: CLEAN[name](rows) for name, rows in _raw(feed, redelivered=True).items()}
    return quality.contract_summary(frames, CONTRACTS)


def contract_gate(feed: Feed) -> DataFrame:
    """Failures that the writing jobs observe: required values of cleaned rows, accepted values of rows as they come."""
    report = quality.ContractReport()
    for name, rows in _cleaned(feed).items():
        _observe(feed, rows, replace(CONTRACTS[name], accepted=()), report)
    for name, rows in _raw(feed, False).items():
        _observe(feed, rows, replace(CONTRACTS[name], not_null=()), report)
    return report.frame(feed.spark)


def _observe(feed: Feed, rows: DataFrame, contract: Contract, report: quality.ContractReport) -> None:
    observed = quality.observed(rows, contract)
    if observed.seen is not None:
        write_table(
            observed.rows, new_scratch_folder(feed.spark, "gate"), "gate", contract.table,
            check=lambda: report.add(observed.failures()),
        )


def _each_source(feed: Feed, run: Callable[[DataFrame, str], DataFrame], frames: dict[str, DataFrame]) -> DataFrame:
    parts = [run(rows, name).withColumn("table_name", F.lit(name)) for name, rows in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def _profiled(rows: DataFrame, name: str) -> DataFrame:
    """All columns; amounts as decimals and times as text, which have one written form everywhere."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = column.cast("decimal(30,4)")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return quality.profile(rows.select(*columns))


def profile(feed: Feed) -> DataFrame:
    return _each_source(feed, _profiled, _cleaned(feed))


def duplicate_rows(feed: Feed) -> DataFrame:
    return _each_source(feed, lambda rows, name: quality.duplicate_rows(rows), _raw(feed, redelivered=True))


def infer_contract(feed: Feed) -> DataFrame:
    return _each_source(feed, lambda rows, name: quality.infer_contract(rows, name.removeprefix("stg_")), _cleaned(feed))


QUERIES: dict[str, Callable[[Feed], DataFrame]] = {
    "raw_landing": raw_landing,
    "raw_quarantine": raw_quarantine,
    "incremental_ingest": incremental_ingest,
    "full_refresh": full_refresh,
    "high_water_mark": high_water_mark,
    "upsert_by_key": upsert_by_key,
    "stg_licenses": lambda feed: stage_landed(feed.delivered(LICENSES), LICENSES),
    "stg_transactions": lambda feed: stage_landed(feed.delivered(TRANSACTIONS), TRANSACTIONS),
    "stg_events": stg_events,
    "latest_per_key": newest_licenses,
    "company_key": company_keys,
    "iso_country": iso_country,
    "customers": lambda feed: feed.hub,
    "company_bridge": company_bridge,
    "feature_usage": lambda feed: feed.usage,
    "match_rate": lambda feed: customers.match_rate(feed.keyed, feed.hub),
    "monthly_mrr": lambda feed: feed.mrr,
    "renewal_gap": renewal_gap,
    "first_sale": lambda feed: subscriptions.first_sale(feed.transactions),
    "trial_lifecycle": lambda feed: feed.trials,
    "trial_outcome": trial_outcome,
    "acquisitions": lambda feed: subscriptions.acquisitions(feed.transactions, feed.licenses),
    "month_spread": month_spread,
    "annual_cohort_matrix": lambda feed: subscriptions.annual_cohort_matrix(
        feed.transactions, feed.licenses, PARAMS
    ),
    "prior_mrr": lambda feed: marts.prior_amounts(feed.mrr).select(
        "transaction_id", "billing_period", "mrr", "prior_mrr"
    ),
    "mrr_movement": lambda feed: marts.movements(feed.mrr).select("transaction_id", "mrr_movement_type", "mrr"),
    "active_customers": lambda feed: marts.active_customers(feed.mrr),
    "trial_conversion": lambda feed: marts.trial_conversion(feed.trials, PARAMS),
    "trial_conversion_literal": trial_conversion_literal,
    "mrr_churn": lambda feed: feed.churn,
    "usage_by_trial": usage_by_trial,
    "feature_adoption": lambda feed: feed.adoption,
    "license_signal": lambda feed: marts.license_signal(feed.licenses, PARAMS),
    "revenue_signal": lambda feed: marts.revenue_signal(feed.mrr),
    "median_mrr": median_mrr,
    "engagement_signal": lambda feed: marts.engagement_signal(feed.usage, PARAMS),
    "customer_health": lambda feed: marts.customer_health(feed.licenses, feed.mrr, feed.usage, PARAMS),
    "report_active_customers": active_report,
    "report_trial_conversion": conversion_report,
    "report_nrr_churn": lambda feed: reports.nrr_churn_report(feed.churn, PARAMS),
    "report_feature_signal": lambda feed: reports.feature_signal_report(feed.adoption, PARAMS),
    "finding_multi_product": lambda feed: reports.multi_product_share(feed.hub),
    "finding_mau_per_license": lambda feed: reports.users_per_license(feed.keyed, feed.licenses, PARAMS),
    "finding_zero_value_trials": lambda feed: reports.zero_value_trials(feed.trials),
    "finding_zero_value_customers": lambda feed: reports.zero_value_customers(feed.mrr),
    "finding_feature_depth": lambda feed: reports.feature_depth(feed.usage),
    "check_not_null": lambda feed: _each_contract(quality.not_null_failures, _cleaned(feed), "not_null"),
    "check_unique": lambda feed: _each_contract(quality.unique_failures, _raw(feed, True), "unique"),
    "check_accepted_values": lambda feed: _each_contract(
        quality.accepted_value_failures, _raw(feed, False), "accepted"
    ),
    "fk_violations": fk_violations,
    "contract_summary": contract_summary,
    "contract_gate": contract_gate,
    "layer_monthly_mrr": lambda feed: subscriptions.monthly_mrr(feed.written.transactions, feed.written.licenses),
    "layer_trial_lifecycle": lambda feed: feed.written.trials,
    "layer_acquisitions": lambda feed: subscriptions.acquisitions(feed.written.transactions, feed.written.licenses),
    "layer_fk_violations": lambda feed: fk_violations(feed.written),
    "layer_revenue_signal": lambda feed: marts.revenue_signal(feed.written.mrr),
    "layer_engagement_signal": lambda feed: marts.engagement_signal(feed.written.usage, PARAMS),
    "profile": profile,
    "duplicate_rows": duplicate_rows,
    "infer_contract": infer_contract,
}


@lru_cache(maxsize=4)
def _feed(spark: SparkSession, sf_dir: str) -> Feed:
    """One set of lazy frames per folder: plans are shared, no rows are kept."""
    return Feed(spark, sf_dir)


def _registered(run: Callable[[Feed], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(run(_feed(prepare_session(spark), sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Monthly net revenue retention and logo churn."""
    return queries()["report_nrr_churn"](spark, "/root/testdata/sf0.001")


def _text_operators() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the subpackage for text corpora and of its pipeline, where they can be imported."""
    try:
        from subtide.llm import queries as text_queries
    except ImportError:
        return {}, {}
    runs, sql = dict(text_queries.QUERIES), dict(text_queries.oracle_sql())
    try:
        import corpus_pipeline
    except ImportError:
        pass
    else:
        runs["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: _prepared(run) for name, run in runs.items()}, sql


def _prepared(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(prepare_session(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(run) for name, run in QUERIES.items()} | _text_operators()[0]


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | _text_operators()[1]
