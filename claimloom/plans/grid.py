"""A whole grid of what-if rates from one pass over the claims.

What is kept of a claim's fee is piecewise linear in the rate that is varied, but for the rounding to cents: up to a
break point it changes with the rate, beyond it it stands still. The claims are read and joined to their terms once for
all rates. One expression per claim gives what is kept at every rate of the grid; only the rates at which it changes
become rows, with the change, so a claim beyond its break point adds none. The changes are added up per partner and
rate before the shuffle, and a running sum over the few rates of the grid answers them all.

With ``rates`` ascending, the rows are those of the scenarios of ``scenarios.py`` for each rate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.plans.economics import with_terms

MEASURES = ["claims", "net_retained_cents", "scenario_retained_cents"]


def _standing(claim_facts: DataFrame, terms: DataFrame) -> DataFrame:
    now = claim_facts.where(~F.col("is_reverted")).select(
        "partner", "price_cents", "pbm_fee_cents", F.col("retained_fee_cents").alias("today_cents")
    )
    return with_terms(now, terms)


def _grid(claims: DataFrame, at: Callable[[Column], Column], rates: Sequence[float]) -> DataFrame:
    """Per rate and partner the sums of ``at(rate)``, which each claim adds as its value at the first rate and its changes.

    ``claims``: partner, today_cents and what ``at`` needs. Only changes that are not zero become rows, so a claim whose
    break point lies left of the grid adds one row, and partial sums per (partner, rate) are combined before the shuffle.
    """
    grid = F.array(*(F.lit(r) for r in rates))
    values = claims.withColumn("__at", F.transform(grid, at))
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice("__at", 1, len(rates) - 1))
    change = F.transform(
        F.arrays_zip(F.col("__at").alias("now"), before.alias("before")),
        lambda v, i: F.struct(i.alias("i"), (v["now"] - v["before"]).alias("change")),
    )
    moved = F.filter(change, lambda c: (c["change"] != 0) | (c["i"] == 0))
    steps = values.select("partner", "today_cents", F.explode(moved).alias("__c"))
    first = F.col("__c.i") == 0
    per_step = steps.groupBy("partner", F.col("__c.i").alias("i")).agg(
        F.count_if(first).alias("claims"),
        F.sum(F.when(first, F.col("today_cents")).otherwise(0)).alias("net_retained_cents"),
        F.sum("__c.change").alias("scenario_retained_cents"),
    )
    # Every rate of the grid for every partner, then a running sum over the rates: as many rows as the answer.
    partners = per_step.select("partner").distinct()
    rows = partners.select("partner", F.posexplode(grid).alias("i", "rate"))
    filled = rows.join(per_step, ["partner", "i"], "left").fillna(0, MEASURES)
    so_far = Window.partitionBy("partner").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    summed = filled.select("partner", "rate", *(F.sum(m).over(so_far).alias(m) for m in MEASURES))
    return summed.withColumn("gain_cents", F.col("scenario_retained_cents") - F.col("net_retained_cents"))


def partner_terms_grid(claim_facts: DataFrame, terms: DataFrame, partner: str, rates: Sequence[float]) -> DataFrame:
    """One partner moves to a percentage share, for many shares: rows (partner, rate, ...) of that partner."""
    claims = _standing(claim_facts.where(F.col("partner") == partner), terms)
    collected = F.col("pbm_fee_cents")

    def retained(rate: Column) -> Column:
        paid = F.least(F.round(collected * rate).cast("bigint"), collected)
        return collected - paid

    return _grid(claims, retained, rates)


def reprice_band_grid(claim_facts: DataFrame, terms: DataFrame, min_price_cents: int, rates: Sequence[float]) -> DataFrame:
    """Claims from a price on are charged a share of it, for many shares: rows (partner, rate, ...)."""
    claims = _standing(claim_facts, terms)
    in_band = F.col("price_cents") >= min_price_cents

    def retained(rate: Column) -> Column:
        fee = F.when(in_band, F.round(F.col("price_cents") * rate).cast("bigint")).otherwise(F.col("pbm_fee_cents"))
        contracted = (
            F.when(F.col("fee_model") == "flat", F.col("flat_fee_cents"))
            .when(F.col("fee_model") == "percentage", F.round(fee * F.col("fee_rate")).cast("bigint"))
            .otherwise(F.lit(0).cast("bigint"))
        )
        return fee - F.least(contracted, fee)

    return _grid(claims, retained, rates)
