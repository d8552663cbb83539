"""Questions asked of the marts (A9-A17, O1, O2, R1, R2). Ordered the way they are read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import safe_ratio
from claimloom.operators import sketches
from claimloom.operators.joins import attach
from claimloom.operators.classify import first_match
from claimloom.operators.reshape import pivot_sum, to_long, top, with_share_of_total
from claimloom.plans.dims import SYNTHETIC_PARTNERS

# The first price in cents above each band, and the band labels.
BANDS = [(10_000, "1 · up to $100"), (1_000_000, "2 · $100 to $10k"), (None, "3 · above $10k")]


def value_band(price_cents: str) -> Column:
    """Half-open bands, tested in order."""
    return first_match([(label, "true" if limit is None else f"{price_cents} < {limit}") for limit, label in BANDS])


def headline_totals(claim_facts: DataFrame) -> DataFrame:
    return claim_facts.agg(
        F.count("*").alias("claims"),
        F.count_if("is_reverted").alias("reverted"),
        F.sum("net_price_cents").alias("net_gmv_cents"),
        F.sum("net_retained_cents").alias("net_retained_cents"),
        F.count_if(~F.col("has_cost_match")).alias("claims_without_cost"),
    )


def reject_summary(rejects: DataFrame) -> DataFrame:
    grouped = rejects.groupBy("defect_class", "detected_in", "source_table", "reject_reason")
    return grouped.agg(F.count("*").alias("rows")).orderBy("defect_class", F.desc("rows"))


def reject_share(rejects: DataFrame) -> DataFrame:
    by_class = rejects.groupBy("defect_class").agg(F.count("*").alias("rows"))
    return with_share_of_total(by_class, "rows", "pct").orderBy(F.desc("rows"))


def reject_audit(rejects: DataFrame, reason: str = "unparseable_number", n: int = 3) -> DataFrame:
    """A few rejected rows with the text that arrived."""
    rows = rejects.where(F.col("reject_reason") == reason).select("record_id", "raw_payload")
    return top(rows, [F.col("record_id"), F.col("raw_payload")], n)


def partners_in_chain(claim_facts: DataFrame, chain: str) -> DataFrame:
    return (
        claim_facts.where(F.col("chain") == chain)
        .groupBy("partner")
        .agg(
            F.count("*").alias("claims"),
            F.sum("net_claim_count").alias("net_claims"),
            F.sum("net_price_cents").alias("net_gmv_cents"),
            F.sum("net_pbm_fee_cents").alias("fee_collected_cents"),
            F.sum("net_partner_fee_cents").alias("payout_cents"),
            F.sum("net_retained_cents").alias("net_retained_cents"),
            safe_ratio("count_if(is_reverted)", "count(*)").alias("reversal_rate"),
        )
        .orderBy(F.desc("net_retained_cents"))
    )


def partner_ranking(performance: DataFrame) -> DataFrame:
    """Partners with claims, best retained revenue first."""
    return (
        performance.where("claims > 0")
        .select(
            "partner",
            "fee_model",
            "lookups",
            "claims",
            "net_retained_cents",
            "net_partner_payout_cents",
            "conversion_rate",
            "reversal_rate",
            "fee_retention",
            "revenue_cents_per_lookup",
        )
        .orderBy(F.desc("net_retained_cents"))
    )


def partner_quality(performance: DataFrame) -> DataFrame:
    """Quality measures beside the terms, real partners only."""
    return (
        performance.where(~F.col("is_synthetic"))
        .select("partner", "fee_model", "conversion_rate", "reversal_rate", "fee_retention", "net_retained_cents")
        .orderBy(F.desc("net_retained_cents"))
    )


def fee_mix_long(performance: DataFrame) -> DataFrame:
    """Kept and paid-out cents per partner with claims, one row per side."""
    sides = performance.where("claims > 0").select(
        "partner", F.col("net_retained_cents").alias("retained"), F.col("net_partner_payout_cents").alias("payout")
    )
    return to_long(sides, ["partner"], ["retained", "payout"], "side", "cents")


def chain_partner_pivot(claim_facts: DataFrame, partners: Mapping[str, str]) -> DataFrame:
    """Retained cents per chain, one column per partner; ``partners`` maps a partner to its column name."""
    return pivot_sum(claim_facts, "chain", "partner", partners, "net_retained_cents")


def price_fee_points(claim_facts: DataFrame) -> DataFrame:
    """Price against fee in dollars, one point per claim that stands."""
    return claim_facts.where(~F.col("is_reverted")).select(
        (F.col("price_cents").cast("double") / 100).alias("price_usd"),
        (F.col("pbm_fee_cents").cast("double") / 100).alias("fee_usd"),
    )


def value_bands(claim_facts: DataFrame) -> DataFrame:
    return (
        claim_facts.where(~F.col("is_reverted"))
        .groupBy(value_band("price_cents").alias("band"))
        .agg(
            F.count("*").alias("claims"),
            F.sum("price_cents").alias("gmv_cents"),
            F.sum("pbm_fee_cents").alias("fee_cents"),
            safe_ratio("sum(pbm_fee_cents)", "sum(price_cents)").alias("take_rate"),
        )
        .orderBy("band")
    )


def top_generic_savings(drug_economics: DataFrame, n: int = 10) -> DataFrame:
    rows = drug_economics.where("generic_substitution_savings_cents > 0").select(
        "ndc",
        "ndc_description",
        "drug_class",
        "net_claims",
        "net_gmv_cents",
        "net_retained_cents",
        "generic_substitution_savings_cents",
        "reversal_rate",
    )
    return top(rows, [F.desc("generic_substitution_savings_cents"), F.col("ndc")], n)


def reversal_cost(claim_facts: DataFrame) -> DataFrame:
    """Retained fee lost to reversals against both denominators, and the median hours to a reversal.

    The exact median is kept as counts per distinct hour value, so its size does not grow with the rows.
    """
    totals = claim_facts.agg(
        F.sum(F.when(F.col("is_reverted"), F.col("retained_fee_cents"))).alias("revenue_lost_cents"),
        F.sum("retained_fee_cents").alias("revenue_potential_cents"),
        F.sum("net_retained_cents").alias("net_retained_cents"),
        F.median("hours_to_revert").alias("median_hours_to_revert"),
    )
    return totals.withColumns(
        {
            "share_of_potential": safe_ratio("revenue_lost_cents", "revenue_potential_cents"),
            "share_of_retained": safe_ratio("revenue_lost_cents", "net_retained_cents"),
        }
    )


def weekly_distinct(daily_sketches: DataFrame) -> DataFrame:
    """Estimated distinct pharmacies and drugs per week and partner, from the daily sketches alone."""
    week = F.trunc("date_day", "week").alias("week_start")
    merged = sketches.merged(daily_sketches, [week, "partner"], ["pharmacies_sketch", "drugs_sketch"], sums=["claims"])
    return sketches.distinct_estimates(merged, {"pharmacies_sketch": "pharmacies", "drugs_sketch": "drugs"})


def median_hours(daily_sketches: DataFrame) -> DataFrame:
    """Estimated median hours to a reversal per partner, from the daily sketches alone."""
    merged = sketches.merged(daily_sketches, ["partner"], quantiles=["hours_sketch"], sums=["reversals"])
    return merged.select("partner", "reversals", sketches.quantile("hours_sketch", 0.5, "reversals").alias("median_hours"))


def weekly_distinct_checked(daily_sketches: DataFrame, claim_facts: DataFrame) -> DataFrame:
    """The weekly estimates beside exact counts: whether each is within its error."""
    week = F.trunc("filled_date", "week").alias("week_start")
    exact = claim_facts.groupBy(week, "partner").agg(
        F.count_distinct("pharmacy_npi").alias("exact_pharmacies"), F.count_distinct("ndc").alias("exact_drugs")
    )
    both = weekly_distinct(daily_sketches).join(exact, ["week_start", "partner"])
    return both.select(
        "week_start",
        "partner",
        "claims",
        "exact_pharmacies",
        "exact_drugs",
        sketches.near_distinct("pharmacies", "exact_pharmacies").alias("pharmacies_near"),
        sketches.near_distinct("drugs", "exact_drugs").alias("drugs_near"),
    )


def median_hours_checked(daily_sketches: DataFrame, claim_facts: DataFrame) -> DataFrame:
    """Per partner whether the estimated median has a rank near one half among the claims' own hours."""
    placed = attach(claim_facts.where("hours_to_revert IS NOT NULL"), median_hours(daily_sketches).drop("reversals"), "partner")
    ranked = placed.groupBy("partner").agg(
        F.count("*").alias("reversals"),
        F.count_if(F.col("hours_to_revert") < F.col("median_hours")).alias("below"),
        F.count_if(F.col("hours_to_revert") <= F.col("median_hours")).alias("upto"),
    )
    return ranked.select("partner", "reversals", sketches.near_rank("below", "upto", "reversals", 0.5).alias("median_near"))


def cross_month_reversals(claim_facts: DataFrame) -> DataFrame:
    """Reversals per fill month, and how many of them came in another month than the fill."""
    other = "count_if(trunc(reverted_at, 'month') <> trunc(filled_date, 'month'))"
    return (
        claim_facts.where("is_reverted")
        .groupBy(F.trunc("filled_date", "month").alias("fill_month"))
        .agg(
            F.count("*").alias("reversals"),
            F.expr(other).alias("in_other_month"),
            safe_ratio(other, "count(*)").alias("other_month_share"),
        )
        .orderBy("fill_month")
    )


def weekly_reversal_rate(funnel: DataFrame) -> DataFrame:
    """Cohort reversal rate per fill week and real partner: summed first, divided after."""
    return (
        funnel.where(~F.col("partner").isin(*SYNTHETIC_PARTNERS))
        .groupBy("week_start", "partner")
        .agg(F.sum("claims").alias("claims"), F.sum("claims_filled_then_reverted").alias("reverted"))
        .withColumn("rate", safe_ratio("reverted", "claims"))
        .orderBy("week_start", "partner")
    )
