"""The checks of the warehouse (Q1-Q8): what must be unique, present, listed, referenced and in balance.

Every check yields one row (check_name, violations). Row predicates of a table are counted in one pass over it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.assertions import count_violations, repeated_keys, unreferenced, violation_count
from claimloom.plans.quarantine import DEFECT_CLASSES, REASONS
from claimloom.plans.staging import CLAIM_REASONS, LOOKUP_REASONS, REVERT_REASONS
from claimloom.plans.warehouse import Warehouse

MAX_REJECTION_RATE = 0.20


@dataclass(frozen=True)
class TableChecks:
    """``unique``: key column lists. ``references``: column -> (parent table, parent column)."""

    unique: list[list[str]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


# Declared per layer, in build order. An accepted list judges only values that are present.
STAGING = {
    "stg_pharmacies": TableChecks([["npi"]], ["npi", "chain"]),
    "stg_partners": TableChecks([["partner"]], ["partner"], {"fee_model": ["flat", "percentage", "unknown"]}),
    "stg_claims": TableChecks(accepted={"dq_reject_reason": CLAIM_REASONS}),
    "stg_reverts": TableChecks(accepted={"dq_reject_reason": REVERT_REASONS}),
    "stg_lookups": TableChecks(accepted={"dq_reject_reason": LOOKUP_REASONS}),
    "clean_lookups": TableChecks([["lookup_id"]]),
    "stg_price_history": TableChecks(
        [["ndc", "effective_date"]], ["unit_cost_usd"], {"drug_class": ["brand", "generic", "unknown"]}
    ),
}
INTERMEDIATE = {
    "claims_scoped": TableChecks(
        [["claim_id"]], ["claim_id"], {"scope_exclusion_reason": ["unknown_npi"]}
    ),
    "reverts_scoped": TableChecks(
        [["revert_id"]], ["revert_id", "claim_id"], {"scope_exclusion_reason": ["orphan_claim_id"]}
    ),
    "lookups_resolved": TableChecks([["lookup_id"]], ["lookup_id", "converted", "has_unresolvable_claim_id"]),
    "claim_cost": TableChecks([["claim_id"]], ["claim_id"], {"cost_basis": ["as_of_fill_date", "no_match"]}),
    "claim_attribution": TableChecks([["claim_id"]], ["claim_id", "partner"]),
    "claim_revert": TableChecks([["claim_id"]], ["claim_id"]),
    "claim_economics": TableChecks([["claim_id"]], ["claim_id", "partner_fee_cents", "retained_fee_cents"]),
}
DIMENSIONS = {
    "dim_pharmacy": TableChecks([["pharmacy_npi"]], ["pharmacy_npi", "chain"]),
    "dim_partner": TableChecks([["partner_name"]], ["partner_name"]),
    "dim_drug": TableChecks([["ndc"]], ["ndc"]),
    "dim_date": TableChecks([["date_day"]], ["date_day"]),
}
FACTS = {
    "fct_claim": TableChecks(
        [["claim_id"]],
        [
            "claim_id",
            "pharmacy_npi",
            "partner",
            "ndc",
            "chain",
            "filled_date",
            "price_cents",
            "is_reverted",
            "net_retained_cents",
        ],
        references={
            "pharmacy_npi": ("dim_pharmacy", "pharmacy_npi"),
            "partner": ("dim_partner", "partner_name"),
            "ndc": ("dim_drug", "ndc"),
            "filled_date": ("dim_date", "date_day"),
        },
    ),
    "fct_lookup": TableChecks(
        [["lookup_id"]],
        ["lookup_id", "partner"],
        references={"partner": ("dim_partner", "partner_name"), "claim_id": ("fct_claim", "claim_id")},
    ),
    "dq_rejects": TableChecks(
        not_null=["reject_reason", "defect_class"],
        accepted={
            "reject_reason": REASONS,
            "defect_class": list(dict.fromkeys(DEFECT_CLASSES.values())),
            "detected_in": ["staging", "intermediate"],
        },
    ),
}
MARTS = {
    "mart_partner_performance": TableChecks([["partner"]], ["partner"]),
    "mart_drug_economics": TableChecks([["ndc"]], ["ndc"]),
    "mart_funnel_daily": TableChecks(
        [["date_day", "partner", "channel"]],
        ["claims_filled_then_reverted", "reverts_on_day", "revenue_reversed_cents"],
    ),
}


def key_checks(wh: Warehouse, tables: dict[str, TableChecks]) -> Iterable[DataFrame]:
    for name, checks in tables.items():
        df = getattr(wh, name)
        for keys in checks.unique:
            yield violation_count(f"{name}.{'+'.join(keys)}.unique", repeated_keys(df, keys))
        if checks.not_null:
            yield count_violations(df, {f"{name}.{c}.not_null": f"{c} IS NULL" for c in checks.not_null})


def unlisted(column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{column} NOT IN ({listed})"


def enum_checks(wh: Warehouse, tables: dict[str, TableChecks]) -> Iterable[DataFrame]:
    for name, checks in tables.items():
        if checks.accepted:
            predicates = {f"{name}.{c}.accepted": unlisted(c, v) for c, v in checks.accepted.items()}
            yield count_violations(getattr(wh, name), predicates)


def reference_checks(wh: Warehouse, tables: dict[str, TableChecks]) -> Iterable[DataFrame]:
    for name, checks in tables.items():
        for column, (parent, parent_column) in checks.references.items():
            missing = unreferenced(getattr(wh, name), column, getattr(wh, parent), parent_column)
            yield violation_count(f"{name}.{column}.references.{parent}", missing)


def split_predicates() -> dict[str, str]:
    """The split adds up to the collected fee, pays out no more than it, and retains nothing negative."""
    return {
        "split.reconciles": "partner_fee_cents + retained_fee_cents <> pbm_fee_cents",
        "split.never_exceeds_fee": "partner_fee_cents > pbm_fee_cents OR retained_fee_cents < 0",
    }


def net_zero_predicates() -> dict[str, str]:
    nets = ["net_price_cents", "net_pbm_fee_cents", "net_partner_fee_cents", "net_retained_cents", "net_claim_count"]
    return {f"reverted.{c}.is_zero": f"is_reverted AND {c} <> 0" for c in nets}


def row_conservation(wh: Warehouse) -> DataFrame:
    """Per event source: landed rows, rows kept, rows in quarantine, and what is missing between them."""
    kept = {"claims": wh.fct_claim, "reverts": wh.reverts_scoped, "lookups": wh.fct_lookup}
    kept["reverts"] = kept["reverts"].where(F.col("scope_exclusion_reason").isNull())
    zero = F.lit(0).cast("bigint")

    def counted(df: DataFrame, side: str, source: Column) -> DataFrame:
        n = df.groupBy(source.alias("source_table")).agg(F.count("*").alias("n"))
        return n.select("source_table", *((F.col("n") if s == side else zero).alias(s) for s in SIDES))

    parts = [counted(wh.raw[s], "landed", F.lit(s)) for s in kept]
    parts += [counted(df, "kept", F.lit(s)) for s, df in kept.items()]
    parts.append(counted(wh.dq_rejects, "rejected", F.col("source_table")))
    totals = union(parts).groupBy("source_table").agg(*(F.sum(s).alias(s) for s in SIDES))
    return totals.withColumn("lost", F.col("landed") - F.col("kept") - F.col("rejected"))


SIDES = ["landed", "kept", "rejected"]


def rejection_rates(wh: Warehouse) -> DataFrame:
    """Share of each event source that was rejected; a sudden jump means the source changed its shape."""
    landed = union(
        [wh.raw[s].agg(F.count("*").alias("landed")).withColumn("source_table", F.lit(s)) for s in SOURCES]
    )
    rejected = wh.dq_rejects.groupBy("source_table").agg(F.count("*").alias("rejected"))
    both = landed.select("source_table", "landed", F.lit(0).cast("bigint").alias("rejected")).unionByName(
        rejected.select("source_table", F.lit(0).cast("bigint").alias("landed"), "rejected")
    )
    totals = both.groupBy("source_table").agg(F.sum("landed").alias("landed"), F.sum("rejected").alias("rejected"))
    percent = F.try_divide(F.col("rejected").cast("double") * 100, F.col("landed").cast("double"))
    return totals.withColumns(
        {
            "rejection_pct": F.round(percent * 100) / 100,
            "too_high": F.col("rejected") > F.lit(MAX_REJECTION_RATE) * F.col("landed"),
        }
    )


SOURCES = ["claims", "reverts", "lookups"]


def union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_checks(wh: Warehouse, tables: dict[str, TableChecks]) -> list[DataFrame]:
    return [
        *key_checks(wh, tables),
        *enum_checks(wh, tables),
        *reference_checks(wh, tables),
    ]


def fact_invariants(wh: Warehouse) -> list[DataFrame]:
    """Conservation, rejection rate, fee split and net-of-reversal checks."""
    lost = row_conservation(wh).where("lost <> 0")
    too_high = rejection_rates(wh).where("too_high")
    return [
        count_violations(wh.fct_claim, split_predicates() | net_zero_predicates()),
        violation_count("rows.conserved", lost),
        violation_count("rows.rejection_rate", too_high),
    ]




ALL = [STAGING, INTERMEDIATE, DIMENSIONS, FACTS, MARTS]
