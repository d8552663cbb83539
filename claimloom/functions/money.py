"""Integer cents and ratios (P4, P5, F10). Arguments are column names or SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: str) -> Column:
    """A dollar amount (double) as integer cents, half away from zero; NULL when it does not fit a bigint."""
    return F.expr(f"try_cast(round(({amount}) * 100) AS bigint)")


def safe_ratio(numerator: str, denominator: str) -> Column:
    """A double ratio; NULL when the denominator is NULL or zero."""
    return F.expr(f"try_divide(cast({numerator} AS double), cast({denominator} AS double))")
