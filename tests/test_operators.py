import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.operators.latest import latest_per_key, top_k_per_group
from subtide.operators.lookups import left_join_split, orphans, with_country_code
from subtide.operators.median import grouped_middle, positive_median
from subtide.operators.previous import previous_row
from subtide.operators.rollups import distinct_counts, distinct_over, rows_over
from subtide.operators.spread import month_spread


def test_latest_per_key_null_wins_and_ties_are_stable(spark):
    day = datetime(2024, 1, 1)
    rows = [
        (1, day, "old"), (1, day + timedelta(days=1), "new"),
        (2, day, "dated"), (2, None, "undated"),
        (3, day, "same"), (3, day, "same"),
        (4, day, "a"), (4, day, "b"),
        (None, day, "keyless"), (None, day + timedelta(days=1), "keyless new"),
    ]
    df = spark.createDataFrame(rows, "k int, at timestamp, v string")
    kept = {r.k: r.v for r in latest_per_key(df, ["k"], ["at"]).collect()}
    again = {r.k: r.v for r in latest_per_key(df.repartition(3), ["k"], ["at"]).collect()}
    assert kept == again
    assert (kept[1], kept[2], kept[3], kept[None]) == ("new", "undated", "same", "keyless new")


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def brute_previous(rows, order, value):
    last, found = {}, {}
    for row in sorted(rows, key=order):
        found[row["id"]] = last.get(row["k"])
        last[row["k"]] = row[value]
    return found


def test_previous_row_equals_a_plain_walk(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # One key holds a third of the rows, and one of its days very many.
        key = "hot" if i % 3 == 0 else rng.choice([f"k{n}" for n in range(200)] + [None])
        day = date(2024, 1, 1) if i % 6 == 0 else date(2020, 1, 1) + timedelta(days=rng.randrange(1500))
        rows.append({"id": f"t{rng.random():.12f}{i}", "k": key, "day": day, "amount": rng.choice([None, 1.0, 2.0, 3.0])})
    df = spark.createDataFrame(rows, "id string, k string, day date, amount double").repartition(5)
    out = previous_row(df, ["k"], ["day", "id"], {"before": "amount", "day_before": "day"})
    assert set(out.columns) == {"id", "k", "day", "amount", "before", "day_before"}
    got = out.collect()
    order = lambda row: (row["day"], row["id"])
    assert {r.id: r.before for r in got} == brute_previous(rows, order, "amount")
    assert {r.id: r.day_before for r in got} == brute_previous(rows, order, "day")


def test_previous_row_with_unknown_dates_last(spark):
    rows = [("a", None, 3), ("b", date(2024, 1, 1), 1), ("c", date(2024, 1, 2), 2)]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, id string, day date, v int")
    got = {r.id: r.before for r in previous_row(df, ["k"], ["day", "id"], {"before": "v"}).collect()}
    assert got == {"b": None, "c": 1, "a": 2}


def median_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    return positive_median(df, "v", "m").collect()


def test_positive_median(spark):
    rng = random.Random(3)
    samples = [
        [5.0], [1.0, 2.0], [1.0, 1.0, 9.0], [2.0] * 10,
        [rng.lognormvariate(5, 3) for _ in range(500)],
        [rng.lognormvariate(5, 3) for _ in range(501)],
        [round(rng.uniform(99.9, 100.1), 4) for _ in range(400)],
        [1e-9, 1e12, 3.0, 3.0000001],
    ]
    for values in samples:
        noise = [0.0, -4.0, None]
        [row] = median_of(spark, values + noise)
        assert row.m == statistics.median(values)


def test_positive_median_of_nothing_is_one_null_row(spark):
    assert [r.m for r in median_of(spark, [0.0, -1.0, None])] == [None]


def test_counts_beside_rows(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), ("b", None), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "k string, v int")
    counted = distinct_over(rows_over(df, ["k"], "n"), ["k"], "v", "d")
    assert sorted((str(r.k), r.n, r.d) for r in counted.collect()) == [
        ("None", 2, 2), ("None", 2, 2), ("a", 3, 2), ("a", 3, 2), ("a", 3, 2), ("b", 1, 0),
    ]


def test_month_spread(spark):
    cohort = date(2024, 1, 1)
    rows = [("inside", cohort, date(2024, 3, 1)), ("before", cohort, date(2023, 10, 1)),
            ("late", cohort, date(2025, 6, 1)), ("past", cohort, date(2026, 1, 1)), ("gone", cohort, date(2022, 12, 1))]
    df = spark.createDataFrame(rows, "k string, cohort date, start date")
    months = {}
    for row in month_spread(df, "cohort", "start", "month", periods=24).collect():
        months.setdefault(row.k, []).append(row.month)
    assert {k: len(v) for k, v in months.items()} == {"inside": 12, "before": 9, "late": 7}
    assert min(months["before"]) == cohort and min(months["inside"]) == date(2024, 3, 1)
    assert max(months["late"]) == date(2025, 12, 1)


def test_top_k(spark):
    rows = [("p", "a", 2.0), ("p", "b", None), ("p", "c", 2.0), ("p", "d", 9.0), ("q", "e", 1.0)]
    df = spark.createDataFrame(rows, "g string, e string, v double")
    best = top_k_per_group(df, ["g"], [F.col("v").desc_nulls_first(), F.col("e").asc()], 3)
    assert sorted((r.g, r.rn, r.e) for r in best.collect()) == [("p", 1, "b"), ("p", 2, "d"), ("p", 3, "a"), ("q", 1, "e")]


def test_split_join_equals_a_left_join(spark):
    rng = random.Random(5)
    keys = ["hot", "hot", "a", "b", "left only", None, None]
    left = spark.createDataFrame([(i, rng.choice(keys)) for i in range(300)], "id int, k string")
    right = spark.createDataFrame(
        [("hot", w) for w in range(40)] + [("a", 1), ("b", 2), ("right only", 3), (None, 4)], "k string, w int"
    )
    rows = lambda df: sorted(map(str, df.select("id", "k", "w").collect()))
    assert rows(left_join_split(left, right, "k", "id")) == rows(left.join(right, "k", "left"))


def test_orphans_and_country(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [(r.value, r.n_records) for r in orphans(child, "p", parent, "id").collect()] == [(2, 2)]
    places = spark.createDataFrame([(" GERMANY",), ("Narnia ",), (None,)], "country string")
    known = spark.createDataFrame([("Germany", "DE")], "country_name string, iso_code string")
    assert {r.country_iso for r in with_country_code(places, known).collect()} == {"de", "narnia", None}


@pytest.mark.parametrize("hot", [1, 5000])
def test_grouped_median_equals_the_built_in(spark, hot):
    """Many groups, NULL keys and values, and one group with most rows."""
    rows = spark.range(3000).selectExpr(
        "IF(id % 50 = 0, NULL, id % 40) AS g", "IF(id % 9 = 0, NULL, CAST((id * 7919) % 83 AS DOUBLE)) AS v"
    )
    rows = rows.unionByName(spark.range(hot).selectExpr("99L AS g", "CAST(id % 31 AS DOUBLE) AS v"))
    counted = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    marked = counted.withColumn("m", grouped_middle(["g"], "v", F.col("n")))
    got = {r.g: r.med for r in marked.groupBy("g").agg(F.avg(F.when(F.col("m"), F.col("v"))).alias("med")).collect()}
    assert got == {r.g: r.med for r in rows.groupBy("g").agg(F.median("v").alias("med")).collect()}


def test_distinct_counts_equal_the_built_in(spark):
    rows = spark.range(4000).selectExpr(
        "IF(id % 7 = 0, NULL, id % 5) AS k", "id % 3 AS j", "IF(id % 4 = 0, NULL, id % 91) AS a", "id % 13 AS b", "IF(id % 2 = 0, NULL, 'x' || id % 17) AS c"
    )
    got = distinct_counts(rows, ["k", "j"], {"n_a": "a", "n_b": "b", "n_c": "c"}, "n")
    want = rows.groupBy("k", "j").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"), F.count_distinct("c").alias("n_c")
    )
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert distinct_counts(rows.where("false"), ["k", "j"], {"n_a": "a"}, "n").count() == 0
