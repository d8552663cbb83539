"""Data-quality assertions (Q1-Q3): each returns the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import attach


def repeated_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys (single or composite) that are not unique; NULL single keys are not compared."""
    rows = df if where is None else df.where(where)
    if len(keys) == 1:
        rows = rows.where(F.col(keys[0]).isNotNull())
    return rows.groupBy(*keys).agg(F.count("*").alias("n_records")).where("n_records > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, values: Sequence[str], where: Column | None = None) -> DataFrame:
    """Rows whose value is not in the list; NULL is not judged here."""
    rows = df if where is None else df.where(where)
    return rows.where(~F.col(column).isin(*values))


def unreferenced(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent row; NULL is not judged here."""
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    known = parent.where(F.col(field).isNotNull()).select(F.col(field).alias(column)).distinct()
    return attach(values, known, column, "left_anti")


def violation_count(check: str, violations: DataFrame) -> DataFrame:
    """One row (check_name, violations), also when there is none."""
    return violations.agg(F.count("*").alias("violations")).select(F.lit(check).alias("check_name"), "violations")


def count_violations(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """One row (check_name, violations) per SQL row predicate, all counted in one pass."""
    counts = df.agg(*(F.expr(f"count_if({predicate}) AS n{i}") for i, predicate in enumerate(checks.values())))
    rows = ", ".join(f"named_struct('check_name', '{name}', 'violations', n{i})" for i, name in enumerate(checks))
    return counts.selectExpr(f"inline(array({rows}))")
