"""Elapsed time and calendar attributes (F7, F8). None of it depends on the session time zone.

Arguments are column names or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hours(start: str, end: str) -> str:
    days = f"cast(datediff(cast({end} AS date), cast({start} AS date)) AS bigint)"
    return f"{days} * 24 + hour({end}) - hour({start})"


def hours_crossed(start: str, end: str) -> Column:
    """Hour boundaries crossed between two timestamps: 10:59 to 11:01 is 1."""
    return F.expr(_hours(start, end))


def minutes_crossed(start: str, end: str) -> Column:
    """Minute boundaries crossed between two timestamps; negative when ``end`` is earlier."""
    return F.expr(f"({_hours(start, end)}) * 60 + minute({end}) - minute({start})")


def with_calendar(df: DataFrame, day: str) -> DataFrame:
    """Add the calendar attributes of a date column: Monday weeks, Sunday is day 0."""
    return df.selectExpr(
        "*",
        f"year({day}) AS year",
        f"month({day}) AS month",
        f"trunc({day}, 'month') AS month_start",
        f"trunc({day}, 'week') AS week_start",
        f"dayofweek({day}) - 1 AS day_of_week",
        f"date_format({day}, 'EEEE') AS day_name",
        f"dayofweek({day}) IN (1, 7) AS is_weekend",
    )
