"""Files to marts, loaded in two steps and in one."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from subtide.plans import marts, quality
from subtide.plans.build import SOURCES, Warehouse, refresh_staging, run
from subtide.plans.quality import ContractViolation
from subtide.sources import star_tables
from subtide.sources.layers import Layout, query, read_table, write_table
from subtide.sources.schemas import CONTRACTS
from subtide.sources.seeds import suffix_table

SF_DIR = "/root/testdata/sf0.001"
# The time that decides on copies of a key; deliveries follow it.
TIMES = {
    "marketplace_licenses": "last_updated",
    "marketplace_transactions": "extracted_at",
    "amplitude_events": "event_time",
}


def deliver(spark, root, early):
    for source, table in SOURCES.items():
        rows = star_tables.redelivered(star_tables.RAW[table](spark, SF_DIR), table)
        is_early = F.col(TIMES[source]) < F.lit(date(2024, 1, 15) if "events" in source else date(2022, 1, 1))
        part = rows.where(is_early if early else ~is_early)
        star_tables.deliver(star_tables.envelopes(part, table), f"{root}/raw/{source}/")


def content(df):
    plain = [f.name for f in df.schema.fields if f.dataType.simpleString() != "variant" and f.name != "loaded_at"]
    columns = [F.round(c, 4).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in plain]
    return sorted(map(str, df.select(*columns).collect()))


def test_two_loads_equal_one_full_refresh(spark, folder):
    countries, suffixes = star_tables.countries(spark, SF_DIR), suffix_table(spark)
    files = f"{folder}/files"
    stepwise = Warehouse(spark, f"{folder}/stepwise", buckets=4)
    for early in (True, False):
        deliver(spark, files, early)
        built = run(stepwise, files, countries, suffixes, star_tables.PARAMS)
    stepwise_rows = {name: content(df) for name, df in built.items()}

    at_once = Warehouse(spark, f"{folder}/at_once", buckets=4)
    run(at_once, files, countries, suffixes, star_tables.PARAMS)
    again = run(at_once, files, countries, suffixes, star_tables.PARAMS, full_refresh=True)
    for name, df in again.items():
        assert content(df) == stepwise_rows[name], name
    assert len(again) == 3 + 2 + 5 + 5 + 2
    assert again["contract_failures"].count() == 0

    staged = {name: again[name] for name in CONTRACTS}
    assert quality.contract_summary(staged, CONTRACTS).count() == 0
    assert read_table(spark, at_once.root, "marts", "mart_mrr_churn").count() == len(stepwise_rows["mart_mrr_churn"])

    top = query(spark, "SELECT sale_month, sum(total_mrr) AS total FROM MARTS.MART_MRR_CHURN GROUP BY 1 ORDER BY 1 DESC")
    assert top.first().sale_month == marts.presented(again["mart_mrr_churn"], "mart_mrr_churn").first().sale_month


def test_a_rerun_without_files_changes_nothing(spark, folder):
    """Two loads bring the same license; the older state comes later and loses, also in reruns."""
    files = f"{folder}/files"
    source = "marketplace_licenses"
    warehouse = Warehouse(spark, f"{folder}/warehouse", buckets=2, max_files_per_trigger=1)
    rows = star_tables.RAW[SOURCES[source]](spark, SF_DIR)
    one = rows.where(F.col("addon_license_id") == rows.agg(F.min("addon_license_id")).first()[0])
    for day, status in ((date(2024, 1, 5), "active"), (date(2024, 1, 1), "cancelled")):
        state = one.withColumns({"last_updated": F.lit(day).cast(one.schema["last_updated"].dataType), "status": F.lit(status)})
        star_tables.deliver(star_tables.envelopes(state, SOURCES[source]), f"{files}/")
    first = content(refresh_staging(warehouse, source, f"{files}/"))
    assert content(refresh_staging(warehouse, source, f"{files}/")) == first
    assert content(refresh_staging(warehouse, source, f"{files}/", full_refresh=True)) == first
    assert content(refresh_staging(warehouse, source, f"{files}/")) == first


def test_a_failed_rebuild_leaves_the_old_table(spark, folder):
    """A write that dies midway, after some of its files are out, changes nothing for readers."""
    good = spark.range(100).selectExpr("id", "id % 4 AS month")
    layout = Layout(partition_by="month")
    write_table(good, folder, "marts", "t", layout)
    broken = good.repartition(4, "id").selectExpr("IF(id = 77, raise_error('lost'), id) AS id", "month")
    with pytest.raises(Exception, match="lost"):
        write_table(broken, folder, "marts", "t", layout)
    assert query(spark, "SELECT sum(id) FROM MARTS.T").first()[0] == 4950
    assert read_table(spark, folder, "marts", "t").count() == 100
    for n in range(3):
        now = write_table(good.where(f"id > {n}"), folder, "marts", "t", layout)
        assert query(spark, "SELECT count(*) FROM MARTS.T").first()[0] == now.count() == 99 - n
    # The current version and the one before it are left.
    assert len(os.listdir(f"{folder}/MARTS/t")) == 2
    assert read_table(spark, folder, "marts", "t").count() == 97


def test_readers_keep_the_version_before(spark, folder):
    first = write_table(spark.range(10).toDF("id"), folder, "marts", "u", Layout(bucket_by="id", buckets=2))
    reader = query(spark, "SELECT * FROM MARTS.U")
    write_table(spark.range(5).toDF("other"), folder, "marts", "u")
    assert (reader.count(), first.count()) == (10, 10)
    assert query(spark, "SELECT * FROM MARTS.U").columns == ["other"]


def test_tables_of_two_roots_stay_apart(spark, folder):
    for n in (1, 2):
        write_table(spark.range(n).toDF("id"), f"{folder}/{n}", "marts", "w")
    assert [read_table(spark, f"{folder}/{n}", "marts", "w").count() for n in (1, 2)] == [1, 2]


def planted(spark, root):
    """A delivery of sales with an unknown type, a missing name and a license that nobody has."""
    rows = star_tables.RAW[SOURCES["marketplace_transactions"]](spark, SF_DIR)
    number = F.col("transaction_id").cast("bigint")
    broken = rows.withColumns(
        {
            "sale_type": F.when(number % 100 == 4, "Gift").otherwise(F.col("sale_type")),
            "addon_name": F.when(number % 50 == 2, F.lit(None)).otherwise(F.col("addon_name")),
            "addon_license_id": F.when(number == number, F.lit(-1)).otherwise(F.col("addon_license_id")),
        }
    )
    for source, table in SOURCES.items():
        own = broken if source == "marketplace_transactions" else star_tables.RAW[table](spark, SF_DIR)
        star_tables.deliver(star_tables.envelopes(own, table), f"{root}/raw/{source}/")
    return rows.select(F.count_if(number % 100 == 4), F.count_if(number % 50 == 2), F.count(F.lit(1))).first()


def test_planted_violations_are_reported_or_stop_the_run(spark, folder):
    gifts, unnamed, total = planted(spark, f"{folder}/files")
    countries, suffixes = star_tables.countries(spark, SF_DIR), suffix_table(spark)
    strict = Warehouse(spark, f"{folder}/strict", buckets=2)
    with pytest.raises(ContractViolation, match="sale_type"):
        run(strict, f"{folder}/files", countries, suffixes, star_tables.PARAMS, stop_on_violations=True)
    # Nothing of the broken load is committed, and no model is built.
    assert strict.staging(SOURCES["marketplace_transactions"]).read() is None
    assert not os.path.exists(f"{folder}/strict/MARTS")

    lenient = Warehouse(spark, f"{folder}/lenient", buckets=2, co_located=False)
    built = run(lenient, f"{folder}/files", countries, suffixes, star_tables.PARAMS)
    table = SOURCES["marketplace_transactions"]
    assert [tuple(r) for r in built["contract_failures"].collect()] == [
        (table, "addon_license_id", "relationships", total),
        (table, "addon_name", "not_null", unnamed),
        (table, "sale_type", "accepted_values", gifts),
    ]
    assert gifts > 0 and unnamed > 0 and "int_trial_conversions" not in built
