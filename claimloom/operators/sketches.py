"""Mergeable sketches (A3, A4, opt-in): distinct counts and quantiles that can be added up over any grouping.

An exact distinct count or median needs the rows again for every new grouping. A sketch per fine group is small, and the
sketch of a coarser group is the merge of theirs. Distinct sketches do not depend on the order of rows or merges;
quantile sketches do, within their rank error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 12
"""A distinct sketch has two to this power of buckets: a relative standard error of 1.6 %."""
QUANTILE_K = 800
"""Size of a quantile sketch: a rank error of about 0.4 %."""


def distinct_sketch(column: str | Column) -> Column:
    """Aggregate: the distinct values that are not null."""
    return F.hll_sketch_agg(column, F.lit(LG_BUCKETS))


def quantile_sketch(column: str | Column) -> Column:
    """Aggregate: the distribution of whole numbers that are not null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.kll_sketch_agg_bigint(value.cast("bigint"), QUANTILE_K)


def merged(df: DataFrame, keys: Sequence[str | Column], distinct: Sequence[str] = (), quantiles: Sequence[str] = (),
           sums: Sequence[str] = ()) -> DataFrame:
    """Sketches and sums of finer groups brought together per ``keys``, under their own names."""
    merges = [F.hll_union_agg(c).alias(c) for c in distinct]
    merges += [F.kll_merge_agg_bigint(c).alias(c) for c in quantiles]
    return df.groupBy(*keys).agg(*merges, *(F.sum(c).alias(c) for c in sums))


def distinct_estimates(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Replace distinct sketches by their estimates; ``names``: sketch to estimate."""
    for sketch, out in names.items():
        df = df.withColumn(out, F.hll_sketch_estimate(sketch)).drop(sketch)
    return df


def quantile(sketch: str, rank: float, rows: str) -> Column:
    """The value of a rank between 0 and 1, null where the sketch has no rows."""
    return F.when(F.col(rows) > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank)))


def near_distinct(estimate: str, exact: str, errors: float = 4.0) -> Column:
    """Whether an estimate is within so many standard errors of the exact count, or off by one."""
    allowed = F.greatest(F.lit(1.0), F.col(exact) * F.lit(errors * 1.04 / 2 ** (LG_BUCKETS / 2)))
    return F.abs(F.col(estimate) - F.col(exact)) <= allowed


def near_rank(below: str, upto: str, rows: str, rank: float, error: float = 0.02) -> Column:
    """Whether a value with ``below`` smaller and ``upto`` not larger ones of ``rows`` is within an error of a rank."""
    n = F.col(rows)
    return (F.col(below) <= n * F.lit(rank + error)) & (F.col(upto) >= n * F.lit(rank - error))
