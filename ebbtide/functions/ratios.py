"""Ratios of the gold layer.  Decimal division rounds to six places before any
comparison, so 0.9999996 already counts as 1."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ratios from which a position is compliant or at risk.
COMPLIANT_FROM = Decimal("1.0")
AT_RISK_FROM = Decimal("0.9")


def lcr_ratio(eligible: Column, outflow: Column) -> Column:
    return F.when(outflow > 0, F.round(eligible / outflow, 4))


def lcr_surplus_deficit(eligible: Column, outflow: Column) -> Column:
    return F.when(outflow > 0, F.round(eligible - outflow, 2)).otherwise(eligible)


def lcr_status(eligible: Column, outflow: Column) -> Column:
    """By the ratio, also where the outflow is negative: negative assets over a negative outflow can be
    `Compliant`."""
    ratio = eligible / outflow
    return (
        F.when(outflow == 0, "No Outflows")
        .when(ratio >= F.lit(COMPLIANT_FROM), "Compliant")
        .when(ratio >= F.lit(AT_RISK_FROM), "At Risk")
        .otherwise("Non-Compliant")
    )


def share(part: Column, whole: Column) -> Column:
    """`part / whole` to four places, 0 where the whole is not positive."""
    return F.when(whole > 0, F.round(part / whole, 4)).otherwise(0)


def share_percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round((part / whole) * 100, 4)).otherwise(0)
