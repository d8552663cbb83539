"""Text cleaning (P1, P9, F1). Arguments are column names or SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(x: str) -> Column:
    """Trim spaces; text that is then empty is NULL."""
    return F.expr(f"nullif(trim({x}), '')")


def lower_text(x: str) -> Column:
    return F.expr(f"lower(nullif(trim({x}), ''))")


def upper_text(x: str) -> Column:
    return F.expr(f"upper(trim({x}))")


def or_default(x: str, member: str) -> Column:
    """A named member instead of NULL, so that group-bys keep the row visible."""
    return F.expr(f"coalesce({x}, '{member}')")
