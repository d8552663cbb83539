"""Quarantine by ordered rules (P6-P8, P10, W1): every row keeps exactly one reason, NULL means clean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import attach, spread

Rule = tuple[str, str]
"""A reason and the SQL predicate it stands for."""


def first_match(rules: Sequence[Rule]) -> Column:
    """The reason of the first rule that holds; NULL when none does."""
    return F.expr("CASE " + " ".join(f"WHEN {predicate} THEN '{reason}'" for reason, predicate in rules) + " END")


def any_null(*columns: str) -> str:
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def relabel(code: str, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Map codes to labels; a code without label is ``default``."""
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    otherwise = "" if default is None else f"ELSE '{default}'"
    return F.expr(f"CASE {code} {cases} {otherwise} END")


def repeated_ids(df: DataFrame, key: str, out: str = "occurrences") -> DataFrame:
    """Ids that occur more than once, with their count. NULL counts as one id."""
    return df.groupBy(key).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def with_repeats(df: DataFrame, key: str, out: str = "repeats", parts: int | None = None) -> DataFrame:
    """Add how many rows of the whole batch share the row's id; NULL for an id seen once and for a row without an id.

    Counting is a map-side combined aggregate, and only ids seen more than once are joined back, so neither a hot id
    nor the rows without an id ever meet in one task as a window over the id would make them. The rows are shuffled by
    the id itself, and later joins on it find them in place. With ``parts`` the ids are shuffled before they are counted:
    nearly all are seen once, so counting per task first saves nothing and keeps every id of the task in memory. The wide
    rows are then not sorted either: a part's repeated ids are few and fit in memory.
    """
    keyed = spread(df.select(key).where(F.col(key).isNotNull()), key, parts)
    return attach(spread(df, key, parts), repeated_ids(keyed, key, out), key, hashed=parts is not None)


def with_occurrences(df: DataFrame, key: str, out: str = "id_occurrences") -> DataFrame:
    """Add how many rows of the whole batch share the row's id; the rows without an id count as one."""
    return with_repeats(df, key, out).withColumn(out, occurrences(df, key, out))


def occurrences(df: DataFrame, key: str, repeats: str) -> Column:
    """The count of :func:`with_occurrences` from that of :func:`with_repeats` over the same rows."""
    without = df.where(F.col(key).isNull()).agg(F.count("*")).scalar()
    return F.when(F.col(key).isNull(), without).otherwise(F.coalesce(F.col(repeats), F.lit(1).cast("bigint")))
