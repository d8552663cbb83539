"""What a claim cost, who originated it, how its fee is split, whether it was reversed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import or_default, to_cents
from claimloom.operators.joins import attach
from claimloom.operators.temporal import asof_left_join, earliest_with_count

COST_ATTRIBUTES = [
    "unit_cost_usd",
    "generic_unit_cost_usd",
    "ndc_description",
    "drug_class",
    "pricing_unit",
    "is_otc",
]
TERMS = ["fee_model", "flat_fee_cents", "fee_rate"]


def attribution(lookups: DataFrame, parts: int | None = None) -> DataFrame:
    """The earliest lookup that names a claim originated it; the count shows when there were several."""
    first = earliest_with_count(
        lookups.where(F.col("claim_id").isNotNull()),
        ["claim_id"],
        ["looked_up_at", "lookup_id"],
        ["partner", "channel"],
        "attributing_lookup_count",
        parts,
    )
    return first.select(
        "claim_id",
        or_default("partner", "direct").alias("partner"),
        or_default("channel", "direct").alias("channel"),
        F.col("lookup_id").alias("attributing_lookup_id"),
        "looked_up_at",
        "attributing_lookup_count",
    )


def first_reverts(reverts: DataFrame, parts: int | None = None) -> DataFrame:
    """The earliest reversal of each claim is the one that counts."""
    first = earliest_with_count(reverts, ["claim_id"], ["reverted_at", "revert_id"], [], "revert_event_count", parts)
    return first.select("claim_id", "reverted_at", "revert_id", "revert_event_count")


def with_cost(
    claims: DataFrame,
    prices: DataFrame,
    resolve: Callable[..., DataFrame] = asof_left_join,
    parts: int | None = None,
    **more: DataFrame,
) -> DataFrame:
    """Acquisition cost at the price in force on the fill date; NULL, not zero, when there is none.

    The unit rate is multiplied by the quantity first and rounded to cents after. ``resolve``: the as-of join;
    ``more`` is for it.
    """
    priced = resolve(claims, prices, "ndc", "filled_date", "effective_date", COST_ATTRIBUTES, parts=parts, **more)
    # A cost beyond bigint cents is no cost we know: sums and the match flag then agree that it is missing.
    cost = to_cents("unit_cost_usd * quantity")
    matched = F.col("est_acquisition_cost_cents").isNotNull()
    costed = priced.withColumn("est_acquisition_cost_cents", cost)
    return costed.withColumnRenamed("effective_date", "cost_effective_date").withColumns(
        {
            "cost_basis": F.when(matched, F.lit("as_of_fill_date")).otherwise(F.lit("no_match")),
            "est_generic_cost_cents": to_cents("generic_unit_cost_usd * quantity"),
            "has_cost_match": matched,
        }
    )


def with_terms(df: DataFrame, terms: DataFrame) -> DataFrame:
    """Add the commercial terms of the partner; a partner without terms has the model ``none``."""
    joined = attach(df, terms.select("partner", *TERMS), "partner", reference=True)
    return joined.withColumn("fee_model", or_default("fee_model", "none"))


def with_fee_split(df: DataFrame) -> DataFrame:
    """Split the collected fee in whole cents: the partner's part never exceeds it, the rest is retained."""
    collected = F.col("pbm_fee_cents")
    contracted = (
        F.when(F.col("fee_model") == "flat", F.col("flat_fee_cents"))
        .when(F.col("fee_model") == "percentage", F.round(collected * F.col("fee_rate")).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    paid = F.least(F.col("contracted_partner_fee_cents"), collected)
    over = F.col("contracted_partner_fee_cents") - collected
    return df.withColumn("contracted_partner_fee_cents", contracted).withColumns(
        {
            "partner_fee_cents": paid,
            "retained_fee_cents": collected - paid,
            "partner_fee_was_capped": over > 0,
            "capped_shortfall_cents": F.greatest(over, F.lit(0).cast("bigint")),
        }
    )


def fee_economics(claims: DataFrame, attributed: DataFrame, terms: DataFrame) -> DataFrame:
    """The fee split of every analysable claim; a claim no lookup led to is ``direct`` and pays nobody."""
    origin = attach(
        claims.select("claim_id", "pbm_fee_cents"),
        attributed.select("claim_id", "partner"),
        "claim_id",
    ).withColumn("partner", or_default("partner", "direct"))
    return with_fee_split(with_terms(origin, terms)).select(
        "claim_id",
        "partner",
        "fee_model",
        "pbm_fee_cents",
        "contracted_partner_fee_cents",
        "partner_fee_cents",
        "retained_fee_cents",
        "partner_fee_was_capped",
        "capped_shortfall_cents",
    )
