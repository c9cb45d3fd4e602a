"""Revenue expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtide.functions.dates import months_apart


def monthly_amount(price: Column, billing_period: Column) -> Column:
    """Monthly plans count as they are, every other plan is a yearly price."""
    return F.when(F.upper(billing_period) == "MONTHLY", price).otherwise(price / F.lit(12.0))


def is_renewal_gap(
    sale_type: Column, billing_period: Column, previous_month: Column, month: Column
) -> Column:
    """A renewal that came later than its billing period allows. Never NULL."""
    gap = months_apart(previous_month, month)
    allowed = F.when(F.upper(billing_period) == "ANNUAL", 13).when(
        F.upper(billing_period) == "MONTHLY", 1
    )
    return F.coalesce((sale_type == "RENEWAL") & (gap > allowed), F.lit(False))


def movement(sale_type: Column, gap: Column, amount: Column, prior: Column) -> Column:
    """Class of a revenue row; a gap outranks any change of amount."""
    change = (
        F.when(amount > prior, "expansion").when(amount < prior, "contraction").otherwise("renewal")
    )
    return (
        F.when(sale_type == "NEW", F.lit("new"))
        .when(gap, F.lit("reactivation"))
        .when(sale_type == "RENEWAL", change)
        .otherwise(sale_type)
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient; NULL when the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
