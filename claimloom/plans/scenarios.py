"""What-if questions (D13-D15): change a fee or a term and run the real split again, claim by claim.

These are derived from the fee split; the reference states results for them but has no query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import safe_ratio
from claimloom.plans.economics import with_fee_split, with_terms


def _resplit(claim_facts: DataFrame, terms: DataFrame, fee: Column) -> DataFrame:
    """Standing claims with the retained cents of today and those under other fees or terms, per partner."""
    now = claim_facts.where(~F.col("is_reverted")).select(
        "partner",
        "price_cents",
        "pbm_fee_cents",
        F.col("retained_fee_cents").alias("today_cents"),
    )
    changed = with_fee_split(with_terms(now.withColumn("pbm_fee_cents", fee), terms))
    return (
        changed.groupBy("partner")
        .agg(
            F.count("*").alias("claims"),
            F.sum("today_cents").alias("net_retained_cents"),
            F.sum("retained_fee_cents").alias("scenario_retained_cents"),
        )
        .withColumn("gain_cents", F.col("scenario_retained_cents") - F.col("net_retained_cents"))
    )


def partner_terms(claim_facts: DataFrame, terms: DataFrame, partner: str, rate: float) -> DataFrame:
    """One partner moves to a percentage share of ``rate`` (0 to 1)."""
    moved = F.col("partner") == partner
    new_terms = terms.withColumns(
        {
            "fee_model": F.when(moved, "percentage").otherwise(F.col("fee_model")),
            "flat_fee_cents": F.when(~moved, F.col("flat_fee_cents")),
            "fee_rate": F.when(moved, F.lit(rate)).otherwise(F.col("fee_rate")),
        }
    )
    return _resplit(claim_facts, new_terms, F.col("pbm_fee_cents"))


def reprice_band(claim_facts: DataFrame, terms: DataFrame, min_price_cents: int, rate: float) -> DataFrame:
    """Claims from ``min_price_cents`` on are charged ``rate`` of their price; the others keep their fee."""
    in_band = F.col("price_cents") >= min_price_cents
    fee = F.round(F.col("price_cents") * F.lit(rate)).cast("bigint")
    return _resplit(claim_facts, terms, F.when(in_band, fee).otherwise(F.col("pbm_fee_cents")))


def channel_levers(claim_facts: DataFrame, lookup_facts: DataFrame) -> DataFrame:
    """Per channel: what one more point of conversion and half of the reversals would be worth."""
    zero = F.lit(0).cast("bigint")
    from_lookups = lookup_facts.groupBy("channel").agg(
        F.count("*").alias("lookups"),
        F.count_if("converted").alias("conversions"),
        F.sum("net_retained_cents").alias("converted_retained_cents"),
        zero.alias("claims"),
        zero.alias("reverted_claims"),
        zero.alias("reversed_retained_cents"),
    )
    lost = F.when(F.col("is_reverted"), F.col("retained_fee_cents")).otherwise(zero)
    from_claims = claim_facts.groupBy("channel").agg(
        zero.alias("lookups"),
        zero.alias("conversions"),
        zero.alias("converted_retained_cents"),
        F.count("*").alias("claims"),
        F.count_if("is_reverted").alias("reverted_claims"),
        F.sum(lost).alias("reversed_retained_cents"),
    )
    measures = [c for c in from_lookups.columns if c != "channel"]
    both = from_lookups.unionByName(from_claims).groupBy("channel").agg(*(F.sum(m).alias(m) for m in measures))
    per_conversion = safe_ratio("converted_retained_cents", "conversions")
    return both.withColumns(
        {
            "conversion_rate": safe_ratio("conversions", "lookups"),
            "reversal_rate": safe_ratio("reverted_claims", "claims"),
            "cents_per_conversion_point": per_conversion * F.col("lookups") / 100,
            "cents_if_half_recovered": F.col("reversed_retained_cents").cast("double") / 2,
        }
    )
