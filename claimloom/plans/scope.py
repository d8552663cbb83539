"""Rules that need a second table (D6, D7): is the pharmacy ours, is the claim one we can analyse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import attach

UNKNOWN_PHARMACY = "unknown_npi"
ORPHAN = "orphan_claim_id"


def judge_claims(staged: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """Every staged claim with its chain and, on well-formed rows, the scope reason.

    This is the table the rest of the build reads: clean rows are the analysable claims, the others the quarantine.
    """
    sites = pharmacies.select("npi", "chain")
    out_of_scope = F.col("dq_reject_reason").isNull() & F.col("chain").isNull()
    return attach(staged, sites, "npi", reference=True).withColumn(
        "scope_exclusion_reason", F.when(out_of_scope, F.lit(UNKNOWN_PHARMACY))
    )


def analysable(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("dq_reject_reason").isNull() & F.col("scope_exclusion_reason").isNull())


def claims_scoped(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("dq_reject_reason").isNull()).drop("dq_reject_reason", "chain")


def _known(analysable_claims: DataFrame) -> DataFrame:
    return analysable_claims.select("claim_id", F.lit(True).alias("claim_is_known"))


def judge_reverts(staged: DataFrame, analysable_claims: DataFrame) -> DataFrame:
    """Every staged reversal; a well-formed one without an analysable claim is an orphan, not an error."""
    orphan = F.col("dq_reject_reason").isNull() & F.col("claim_is_known").isNull()
    return (
        attach(staged, _known(analysable_claims), "claim_id")
        .withColumn("scope_exclusion_reason", F.when(orphan, F.lit(ORPHAN)))
        .drop("claim_is_known")
    )


def reverts_scoped(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("dq_reject_reason").isNull()).drop("dq_reject_reason")


def lookups_resolved(staged: DataFrame, analysable_claims: DataFrame) -> DataFrame:
    """Well-formed lookups. One that names a claim we cannot analyse loses the link, not the row."""
    clean = staged.where(F.col("dq_reject_reason").isNull())
    linked = attach(clean, _known(analysable_claims), "claim_id", keyless=True)
    converted = F.coalesce("claim_is_known", F.lit(False))
    return linked.select(
        "lookup_id",
        "ndc",
        "partner",
        "channel",
        "looked_up_at",
        "lookup_date",
        F.when(converted, F.col("claim_id")).alias("claim_id"),
        (F.col("claim_id").isNotNull() & ~converted).alias("has_unresolvable_claim_id"),
        converted.alias("converted"),
        "partner_was_missing",
        "timestamp_raw",
        "_source_file",
    )
