from datetime import date

import pytest
from pyspark.sql import functions as F

from subtide.functions import health, revenue, text
from subtide.functions.dates import month_after, month_of, months_apart, shift_months
from subtide.sources.seeds import LEGAL_SUFFIXES


def evaluate(spark, schema, rows, expression):
    """One value per row, in order."""
    numbered = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
    return [r.out for r in numbered.select("_i", expression.alias("out")).orderBy("_i").collect()]


def test_status_folds_variants_and_keeps_unknowns(spark):
    raw = ["active", "Active", "ACTIVE", "ACTV", " expired ", "cancelled", "paused", None]
    rows = [(value,) for value in raw]
    assert evaluate(spark, "s string", rows, text.license_status(F.col("s"))) == [
        "active", "active", "active", "active", "expired", "cancelled", "paused", None,
    ]
    assert evaluate(spark, "s string", rows, text.is_active_status(F.col("s"))) == [True] * 4 + [False] * 4


def test_hosting_and_missing_text(spark):
    assert evaluate(spark, "s string", [("data center",), (" Server ",), (None,)], text.compact_lower(F.col("s"))) == [
        "datacenter", "server", None,
    ]
    rows = [("",), ("  ",), ("None",), (" None ",), ("none",), (None,), (" pro ",)]
    assert evaluate(spark, "s string", rows, text.missing_text(F.col("s"))) == [
        None, None, None, None, "none", None, "pro",
    ]


@pytest.mark.parametrize(
    ("company", "country", "key"),
    [
        ("Acme, Inc.", "de", "acme|de"),
        ("Acme  GmbH ", "DE", "acme|de"),
        ("ACME limited liability company", "us", "acme|us"),
        ("Widgets Co Ltd", "us", "widgets_co|us"),
        ("Limited", "us", "limited|us"),
        ("日本", "jp", "|jp"),
        ("Acme Inc\n", None, "acme|"),
        (None, "us", None),
    ],
)
def test_company_key(spark, company, country, key):
    expression = text.company_key(F.col("c"), F.col("n"), LEGAL_SUFFIXES)
    assert evaluate(spark, "c string, n string", [(company, country)], expression) == [key]


def test_company_key_ignores_case_and_outer_space(spark):
    names = ["Acme GmbH", "Smith & Sons, Co.", "A-B-C LLC"]
    expression = text.company_key(F.col("c"), F.lit("X"), LEGAL_SUFFIXES)
    plain = evaluate(spark, "c string", [(n,) for n in names], expression)
    changed = evaluate(spark, "c string", [(f"  {n.upper()} ",) for n in names], expression)
    assert plain == changed


def test_country_and_product(spark):
    rows = [("DE", "Germany"), (None, " Narnia "), (None, None)]
    assert evaluate(spark, "i string, c string", rows, text.country_code(F.col("i"), F.col("c"))) == ["de", "narnia", None]
    assert evaluate(spark, "k string", [("x.y.app",)], text.product_name(F.col("k"), "x.y.")) == ["app"]
    assert evaluate(spark, "k string", [("app",)], text.product_name(F.col("k"), "")) == ["app"]


def test_months(spark):
    rows = [(date(2024, 1, 31), date(2024, 2, 1)), (date(2023, 12, 1), date(2024, 2, 29)), (None, date(2024, 1, 1))]
    assert evaluate(spark, "a date, b date", rows, months_apart(F.col("a"), F.col("b"))) == [1, 2, None]
    assert evaluate(spark, "a date, b date", rows[:2], month_of(F.col("b"))) == [date(2024, 2, 1)] * 2
    assert evaluate(spark, "a date, b date", rows[:1], month_after(F.col("a"))) == [date(2024, 2, 1)]
    assert shift_months(date(2024, 3, 1), -6) == date(2023, 9, 1)


def test_monthly_amount(spark):
    rows = [(120.0, "Annual"), (120.0, "monthly"), (120.0, "weekly"), (120.0, None), (None, "Monthly")]
    expression = revenue.monthly_amount(F.col("p"), F.col("b"))
    assert evaluate(spark, "p double, b string", rows, expression) == [10.0, 120.0, 10.0, 10.0, None]


def test_renewal_gap(spark):
    jan = date(2023, 1, 1)
    rows = [
        ("RENEWAL", "Annual", jan, date(2024, 2, 1), False),
        ("RENEWAL", "Annual", jan, date(2024, 3, 1), True),
        ("RENEWAL", "monthly", jan, date(2023, 2, 1), False),
        ("RENEWAL", "Monthly", jan, date(2023, 3, 1), True),
        ("RENEWAL", "Monthly", None, jan, False),
        ("RENEWAL", "Monthly", jan, jan, False),
        ("NEW", "Monthly", jan, date(2023, 9, 1), False),
        ("RENEWAL", "weekly", jan, date(2030, 1, 1), False),
    ]
    expression = revenue.is_renewal_gap(F.col("t"), F.col("b"), F.col("p"), F.col("m"))
    got = evaluate(spark, "t string, b string, p date, m date, want boolean", rows, expression)
    assert got == [row[-1] for row in rows]


def test_movement(spark):
    rows = [
        ("NEW", True, 5.0, 1.0, "new"),
        ("RENEWAL", True, 5.0, 1.0, "reactivation"),
        ("RENEWAL", False, 5.0, None, "renewal"),
        ("RENEWAL", False, 5.0, 1.0, "expansion"),
        ("RENEWAL", False, 1.0, 5.0, "contraction"),
        ("RENEWAL", False, 5.0, 5.0, "renewal"),
        ("UPGRADE", False, 5.0, 1.0, "UPGRADE"),
    ]
    expression = revenue.movement(F.col("t"), F.col("g"), F.col("a"), F.col("p"))
    got = evaluate(spark, "t string, g boolean, a double, p double, want string", rows, expression)
    assert got == [row[-1] for row in rows]


def test_ratio(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 1.0)]
    assert evaluate(spark, "a double, b double", rows, revenue.ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None]


def test_health_scores(spark):
    rows = [(True, 900, 100), (False, 30, 50), (False, -5, 50), (False, 31, 0), (False, None, 0)]
    got = evaluate(spark, "a boolean, d int, w int", rows, health.license_score(F.col("a"), F.col("d")))
    assert got == [row[-1] for row in rows]
    rows = [(None, 10.0, 0), (0.0, 10.0, 0), (20.0, 10.0, 100), (10.0, 10.0, 75), (5.0, 10.0, 50), (4.9, 10.0, 25), (4.0, None, 25)]
    got = evaluate(spark, "a double, m double, w int", rows, health.revenue_score(F.col("a"), F.col("m")))
    assert got == [row[-1] for row in rows]
    rows = [(None, 0), (0, 0), (1, 50), (3, 75), (5, 100)]
    assert evaluate(spark, "f bigint, w int", rows, health.engagement_score(F.col("f"))) == [0, 0, 50, 75, 100]
    rows = [(100, 50, 67, 75.1), (50, 50, 50, 50.0), (100, 75, 75, 85.0)]
    score = health.health_score(F.col("a"), F.col("b"), F.col("c"))
    assert evaluate(spark, "a int, b int, c int, w double", rows, score) == [75.1, 50.0, 85.0]
    got = evaluate(spark, "s double", [(75.0,), (74.9,), (50.0,), (49.9,)], health.health_segment(F.col("s")))
    assert got == ["healthy", "at_risk", "at_risk", "churned_or_inactive"]
