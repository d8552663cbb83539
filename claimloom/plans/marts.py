"""Aggregate marts (A6-A8): per partner, per item, per day x partner x channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import safe_ratio, with_calendar
from claimloom.operators import sketches
from claimloom.operators.joins import attach


def _where(condition: Column, measure: str) -> Column:
    return F.sum(F.when(condition, F.col(measure)))


def _zero_for_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def partner_performance(partners: DataFrame, claim_facts: DataFrame, lookup_facts: DataFrame) -> DataFrame:
    """One row per partner: volume, retained and paid-out fees, conversion and reversal."""
    by_lookup = lookup_facts.groupBy("partner").agg(
        F.count("*").alias("lookups"),
        F.count_if(F.col("channel") == "integration").alias("lookups_integration"),
        F.count_if(F.col("channel") == "website").alias("lookups_website"),
    )
    by_claim = claim_facts.groupBy("partner").agg(
        F.count("*").alias("claims"),
        F.sum("net_claim_count").alias("net_claims"),
        F.count_if("is_reverted").alias("reverted_claims"),
        F.sum("net_retained_cents").alias("net_retained_cents"),
        F.sum("net_partner_fee_cents").alias("net_partner_payout_cents"),
        F.sum("net_pbm_fee_cents").alias("net_pbm_fee_cents"),
        F.sum("net_price_cents").alias("net_gmv_cents"),
        F.sum("pbm_fee_cents").alias("gross_pbm_fee_cents"),
        F.count_if("partner_fee_was_capped").alias("capped_claims"),
        F.sum("capped_shortfall_cents").alias("capped_shortfall_cents"),
        F.avg("pharmacy_margin_cents").alias("avg_pharmacy_margin_cents"),
        F.count_distinct("pharmacy_npi").alias("distinct_pharmacies"),
        F.count_distinct("ndc").alias("distinct_drugs"),
        F.min("filled_date").alias("first_claim_date"),
        F.max("filled_date").alias("last_claim_date"),
    )
    terms = partners.withColumnRenamed("partner_name", "partner")
    joined = attach(terms, by_claim, "partner")
    joined = attach(joined, by_lookup, "partner")
    rated = joined.withColumns(
        {
            "fee_retention": safe_ratio("net_retained_cents", "net_pbm_fee_cents"),
            "conversion_rate": safe_ratio("claims", "lookups"),
            "reversal_rate": safe_ratio("reverted_claims", "claims"),
            "revenue_cents_per_lookup": safe_ratio("net_retained_cents", "lookups"),
            "revenue_cents_per_net_claim": safe_ratio("net_retained_cents", "net_claims"),
        }
    )
    counted = [
        "lookups",
        "claims",
        "net_claims",
        "reverted_claims",
        "net_retained_cents",
        "net_partner_payout_cents",
        "net_pbm_fee_cents",
        "net_gmv_cents",
        "gross_pbm_fee_cents",
        "capped_claims",
        "capped_shortfall_cents",
        "lookups_integration",
        "lookups_website",
    ]
    return _zero_for_null(rated, counted)


def drug_economics(drugs: DataFrame, claim_facts: DataFrame, lookup_facts: DataFrame) -> DataFrame:
    """One row per item: volume, margin levers, rates. Sums over no row stay NULL except the two levers."""
    kept = ~F.col("is_reverted")
    by_lookup = lookup_facts.groupBy("ndc").agg(F.count("*").alias("lookups"))
    by_claim = claim_facts.groupBy("ndc").agg(
        F.count("*").alias("claims"),
        F.sum("net_claim_count").alias("net_claims"),
        F.count_if("is_reverted").alias("reverted_claims"),
        _where(kept, "quantity").alias("net_units"),
        F.sum("net_price_cents").alias("net_gmv_cents"),
        F.sum("net_retained_cents").alias("net_retained_cents"),
        F.sum("net_partner_fee_cents").alias("net_partner_payout_cents"),
        _where(kept, "est_acquisition_cost_cents").alias("net_acquisition_cost_cents"),
        _where(kept, "pharmacy_margin_cents").alias("net_pharmacy_margin_cents"),
        _where(F.col("is_reverted"), "retained_fee_cents").alias("revenue_at_risk_from_reversals_cents"),
        _where(kept, "generic_substitution_savings_cents").alias("generic_substitution_savings_cents"),
        F.avg("unit_cost_usd").alias("avg_unit_cost_usd"),
        F.count_if(~F.col("has_cost_match")).alias("claims_without_cost"),
        F.count_distinct("pharmacy_npi").alias("distinct_pharmacies"),
        F.count_distinct("partner").alias("distinct_partners"),
    )
    items = drugs.select("ndc", "ndc_description", "drug_class", "is_otc", "is_in_nadac")
    joined = attach(items, by_claim, "ndc")
    joined = attach(joined, by_lookup, "ndc")
    rated = joined.withColumns(
        {
            "reversal_rate": safe_ratio("reverted_claims", "claims"),
            "conversion_rate": safe_ratio("claims", "lookups"),
            "take_rate": safe_ratio("net_retained_cents", "net_gmv_cents"),
            "pharmacy_margin_rate": safe_ratio("net_pharmacy_margin_cents", "net_gmv_cents"),
        }
    )
    return _zero_for_null(
        rated, ["revenue_at_risk_from_reversals_cents", "generic_substitution_savings_cents", "lookups"]
    )


def sketches_daily(claim_facts: DataFrame) -> DataFrame:
    """Per fill day and partner: sketches of pharmacies, drugs and hours to reversal, to be merged for any period."""
    return claim_facts.groupBy(F.col("filled_date").alias("date_day"), "partner").agg(
        F.count("*").alias("claims"),
        F.count("hours_to_revert").alias("reversals"),
        sketches.distinct_sketch("pharmacy_npi").alias("pharmacies_sketch"),
        sketches.distinct_sketch("ndc").alias("drugs_sketch"),
        sketches.quantile_sketch("hours_to_revert").alias("hours_sketch"),
    )


FUNNEL_KEYS = ["date_day", "partner", "channel"]
FUNNEL_MEASURES = [
    "lookups",
    "conversions",
    "claims",
    "unresolvable_conversions",
    "claims_filled_then_reverted",
    "reverts_on_day",
    "revenue_reversed_cents",
    "gmv_reversed_cents",
    "net_gmv_cents",
    "net_retained_cents",
    "net_partner_payout_cents",
]


def _funnel_event(day: Column, measures: dict[str, Column]) -> Column:
    """A struct with the day and every funnel measure, zero where the event does not count."""
    zero = F.lit(0).cast("bigint")
    fields = [measures.get(m, zero).cast("bigint").alias(m) for m in FUNNEL_MEASURES]
    return F.struct(day.alias("date_day"), "partner", "channel", *fields)


def funnel_daily(claim_facts: DataFrame, lookups: DataFrame) -> DataFrame:
    """Lookup -> claim -> reversal per day, partner and channel.

    A reversal counts twice under different names: on the day of the fill (cohort) and on its own day (activity).
    All events become rows of one shape and are aggregated once, so there is one shuffle and no spine to join.
    ``lookups`` may be resolved lookups or the lookup fact.
    """
    one = F.lit(1)
    looked_up = lookups.select(
        _funnel_event(
            F.col("lookup_date"),
            {
                "lookups": one,
                "conversions": F.col("converted").cast("int"),
                "unresolvable_conversions": F.col("has_unresolvable_claim_id").cast("int"),
            },
        ).alias("e")
    )
    filled = _funnel_event(
        F.col("filled_date"),
        {
            "claims": one,
            "claims_filled_then_reverted": F.col("is_reverted").cast("int"),
            "net_gmv_cents": F.col("net_price_cents"),
            "net_retained_cents": F.col("net_retained_cents"),
            "net_partner_payout_cents": F.col("net_partner_fee_cents"),
        },
    )
    reversed_ = _funnel_event(
        F.col("reverted_at").cast("date"),
        {
            "reverts_on_day": one,
            "revenue_reversed_cents": F.col("retained_fee_cents"),
            "gmv_reversed_cents": F.col("price_cents"),
        },
    )
    events_of_claim = F.when(F.col("is_reverted"), F.array(filled, reversed_)).otherwise(F.array(filled))
    claimed = claim_facts.select(F.explode(events_of_claim).alias("e"))
    daily = (
        looked_up.unionByName(claimed)
        .select("e.*")
        .groupBy(*FUNNEL_KEYS)
        .agg(*(F.sum(m).alias(m) for m in FUNNEL_MEASURES))
    )
    return with_calendar(daily, "date_day").select(
        "date_day",
        "month_start",
        "week_start",
        "day_name",
        "is_weekend",
        "partner",
        "channel",
        *FUNNEL_MEASURES,
        safe_ratio("conversions", "lookups").alias("conversion_rate"),
        safe_ratio("claims_filled_then_reverted", "claims").alias("cohort_reversal_rate"),
    )
