"""The two facts (D9, D10): one row per analysable claim, one row per lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import hours_crossed, minutes_crossed, or_default
from claimloom.operators.joins import attach
from claimloom.plans.economics import with_cost, with_fee_split, with_terms

CLAIM_COLUMNS = [
    "claim_id",
    "pharmacy_npi",
    "chain",
    "ndc",
    "partner",
    "channel",
    "drug_class",
    "filled_at",
    "filled_date",
    "quantity",
    "price_cents",
    "pbm_fee_cents",
    "partner_fee_cents",
    "retained_fee_cents",
    "fee_model",
    "partner_fee_was_capped",
    "capped_shortfall_cents",
    "unit_cost_usd",
    "est_acquisition_cost_cents",
    "est_generic_cost_cents",
    "cost_basis",
    "cost_effective_date",
    "has_cost_match",
    "is_reverted",
    "reverted_at",
    "revert_id",
    "hours_to_revert",
    "attributing_lookup_id",
    "looked_up_at",
    "minutes_lookup_to_fill",
    "_source_file",
    "pharmacy_margin_cents",
    "generic_substitution_savings_cents",
    "net_price_cents",
    "net_pbm_fee_cents",
    "net_partner_fee_cents",
    "net_retained_cents",
    "net_claim_count",
]


def _unless_reverted(measure: str):
    return F.when(F.col("is_reverted"), F.lit(0).cast("bigint")).otherwise(F.col(measure))


def claim_outcome(claims: DataFrame, attributed: DataFrame, terms: DataFrame, reverted: DataFrame) -> DataFrame:
    """Who originated each claim, how its fee is split and whether it stands: all of the fact but the cost.

    ``claims`` are the analysable claims with their chain; ``attributed`` and ``reverted`` have one row per claim id.
    Both may hold ids that are no analysable claim: the left joins from the claims leave those out, so lookups and
    reversals need not be resolved against the claims first.
    """
    origin = attributed.select("claim_id", "partner", "channel", "attributing_lookup_id", "looked_up_at")
    reversal = reverted.select("claim_id", "reverted_at", "revert_id")
    wide = attach(claims, origin, "claim_id")
    wide = attach(wide, reversal, "claim_id")
    wide = wide.withColumns(
        {"partner": or_default("partner", "direct"), "channel": or_default("channel", "direct")}
    )
    return (
        with_fee_split(with_terms(wide, terms))
        .withColumnRenamed("npi", "pharmacy_npi")
        .withColumns(
            {
                "is_reverted": F.col("reverted_at").isNotNull(),
                "hours_to_revert": hours_crossed("filled_at", "reverted_at"),
                "minutes_lookup_to_fill": minutes_crossed("looked_up_at", "filled_at"),
            }
        )
        .withColumns(
            {
                "net_price_cents": _unless_reverted("price_cents"),
                "net_pbm_fee_cents": _unless_reverted("pbm_fee_cents"),
                "net_partner_fee_cents": _unless_reverted("partner_fee_cents"),
                "net_retained_cents": _unless_reverted("retained_fee_cents"),
                "net_claim_count": F.when(F.col("is_reverted"), 0).otherwise(1),
            }
        )
    )


def claim_fact(outcome: DataFrame, prices: DataFrame, parts: int | None = None) -> DataFrame:
    """One wide row per claim: its outcome, cost and margin."""
    margin = F.col("price_cents") - F.col("est_acquisition_cost_cents") - F.col("pbm_fee_cents")
    savings = F.col("est_acquisition_cost_cents") - F.col("est_generic_cost_cents")
    has_generic = (F.col("drug_class") == "brand") & F.col("est_generic_cost_cents").isNotNull()
    return (
        with_cost(outcome, prices, parts=parts)
        .withColumns(
            {
                # Unknown margin is NULL: averages and sums then skip it instead of reading it as zero.
                "pharmacy_margin_cents": F.when(F.col("has_cost_match"), margin),
                "generic_substitution_savings_cents": F.when(has_generic, savings),
            }
        )
        .select(*CLAIM_COLUMNS)
    )


def lookup_fact(clean_lookups: DataFrame, claim_facts: DataFrame) -> DataFrame:
    """One row per well-formed lookup with the outcome of its claim, if that claim can be analysed.

    Most lookups have no claim id; they are not shuffled. Joining the claim outcome also settles whether the lookup converted, so this needs one join, not two.
    """
    outcome = claim_facts.select("claim_id", "chain", "pharmacy_npi", "is_reverted", "net_retained_cents")
    converted = F.col("is_reverted").isNotNull()
    return attach(clean_lookups, outcome, "claim_id", keyless=True).select(
        "lookup_id",
        F.when(converted, F.col("claim_id")).alias("claim_id"),
        "ndc",
        "partner",
        "channel",
        "looked_up_at",
        "lookup_date",
        converted.alias("converted"),
        (F.col("claim_id").isNotNull() & ~converted).alias("has_unresolvable_claim_id"),
        "partner_was_missing",
        "chain",
        "pharmacy_npi",
        F.coalesce("is_reverted", F.lit(False)).alias("converted_and_reverted"),
        F.coalesce("net_retained_cents", F.lit(0).cast("bigint")).alias("net_retained_cents"),
        "_source_file",
    )
