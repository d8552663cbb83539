"""Pivot, unpivot, top rows and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sum(
    df: DataFrame, rows: str, columns: str, values: Mapping[str, str], measure: str, rest: str = "others"
) -> DataFrame:
    """Sum a measure per row and listed column value; ``values`` maps a value to its output name.

    With the values listed no extra job is needed to find them. What belongs to no listed value is in the column
    ``rest``, so the columns of a row always add up; a combination that does not occur stays NULL.
    """
    listed = F.coalesce(F.col(columns).isin(list(values)), F.lit(False))
    sums = [F.sum(F.when(F.col(columns) == v, F.col(measure))).alias(name) for v, name in values.items()]
    return df.groupBy(rows).agg(*sums, F.sum(F.when(~listed, F.col(measure))).alias(rest))


def to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(measures), name, value)


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_share_of_total(grouped: DataFrame, count: str, out: str, digits: int = 1) -> DataFrame:
    """Percentage of a grouped count in the total of all groups.

    The total is one row beside the groups, no window gathers them.
    """
    total = grouped.agg(F.sum(count)).scalar()
    scale = F.lit(float(10**digits))
    percent = F.col(count).cast("double") * 100 / total.cast("double")
    return grouped.withColumn(out, F.round(percent * scale) / scale)
