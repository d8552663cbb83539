"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import or_default, with_calendar
from claimloom.operators.joins import attach
from claimloom.operators.temporal import calendar, one_per_key

SYNTHETIC_PARTNERS = ["direct", "unknown"]
NO_DESCRIPTION = "(not in NADAC)"


def pharmacy_dim(pharmacies: DataFrame) -> DataFrame:
    return pharmacies.select(F.col("npi").alias("pharmacy_npi"), "chain", "_source_file")


def partner_dim(terms: DataFrame) -> DataFrame:
    """The partners plus named members for claims without lookup and lookups without partner."""
    real = terms.select(
        F.col("partner").alias("partner_name"), "fee_model", "flat_fee_cents", "fee_rate", F.lit(False).alias("is_synthetic")
    )
    synthetic = terms.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, SYNTHETIC_PARTNERS))).alias("partner_name"),
        F.lit("none").alias("fee_model"),
        F.lit(None).cast("bigint").alias("flat_fee_cents"),
        F.lit(None).cast("double").alias("fee_rate"),
        F.lit(True).alias("is_synthetic"),
    )
    return real.unionByName(synthetic)


def drug_dim(claims: DataFrame, lookups: DataFrame, prices: DataFrame) -> DataFrame:
    """Every item seen in our events with the attributes of its latest price, if it has one."""
    observed = claims.select("ndc").unionByName(lookups.select("ndc")).distinct()
    latest = one_per_key(prices, ["ndc"], [F.col("effective_date").desc()]).select(
        "ndc",
        "ndc_description",
        "drug_class",
        "pricing_unit",
        "is_otc",
        F.col("unit_cost_usd").alias("latest_unit_cost_usd"),
        F.col("generic_unit_cost_usd").alias("latest_generic_unit_cost_usd"),
        F.col("effective_date").alias("latest_cost_effective_date"),
    )
    return attach(observed, latest, "ndc").select(
        "ndc",
        or_default("ndc_description", NO_DESCRIPTION).alias("ndc_description"),
        or_default("drug_class", "unknown").alias("drug_class"),
        "pricing_unit",
        "is_otc",
        "latest_unit_cost_usd",
        "latest_generic_unit_cost_usd",
        "latest_cost_effective_date",
        F.col("latest_cost_effective_date").isNotNull().alias("is_in_nadac"),
    )


def date_dim(claims: DataFrame, lookups: DataFrame, reverts: DataFrame) -> DataFrame:
    """Every day from the first to the last event of the three streams.

    ``reverts`` must be those of analysable claims, see :func:`revert_bounds`.
    """
    days = (
        claims.select(F.col("filled_date").alias("first"), F.col("filled_date").alias("last"))
        .unionByName(lookups.select(F.col("lookup_date").alias("first"), F.col("lookup_date").alias("last")))
        .unionByName(reverts.select("first", "last"))
    )
    bounds = days.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return with_calendar(calendar(bounds, "first", "last"), "date_day")


def revert_bounds(clean_reverts: DataFrame, analysable_claims: DataFrame) -> DataFrame:
    """First and last reversal day per analysable claim; reversals are reduced to one row per claim first."""
    per_claim = clean_reverts.groupBy("claim_id").agg(
        F.min("reverted_at").cast("date").alias("first"), F.max("reverted_at").cast("date").alias("last")
    )
    return attach(per_claim, analysable_claims.select("claim_id"), "claim_id", "left_semi")
