"""The registered queries: one per operator of the survey, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.bridge import views
from claimloom.functions import (
    clean_text,
    hours_crossed,
    lower_text,
    minutes_crossed,
    parse_double,
    parse_timestamp,
    safe_ratio,
    with_calendar,
)
from claimloom.operators.assertions import count_violations, repeated_keys, unreferenced, violation_count
from claimloom.operators.classify import repeated_ids
from claimloom.operators.joins import attach
from claimloom.operators.temporal import asof_left_join, calendar, earliest_with_count, interval_left_join, one_per_key
from claimloom.plans import checks, economics, grid, marts, reports, scenarios, staging
from claimloom.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    raw = views.RawTables(spark, sf_dir)
    return Warehouse(raw, raw.parts())


def _over_warehouse(fn: Callable[[Warehouse], DataFrame], name: str | None = None):
    QUERIES[name or fn.__name__] = lambda spark, sf_dir: fn(warehouse(spark, sf_dir))
    return fn


def _over_events(fn: Callable[[DataFrame], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(views.table(spark, sf_dir, "events"))
    return fn


# Parsing.


@_over_warehouse
def clean_text_(wh):
    return wh.raw["lookups"].select(
        F.col("id").alias("raw_id"),
        clean_text("id").alias("id"),
        clean_text("ndc").alias("ndc"),
        clean_text("partner").alias("partner"),
        lower_text("channel").alias("channel"),
    )


QUERIES["clean_text"] = QUERIES.pop("clean_text_")


@_over_warehouse
def safe_parse(wh):
    return wh.raw["claims"].select(
        "id",
        F.col("price").alias("price_raw"),
        parse_double("price").alias("price"),
        parse_double("quantity").alias("quantity"),
        parse_double("pbm_fee").alias("pbm_fee"),
        F.col("timestamp").alias("timestamp_raw"),
        parse_timestamp("timestamp").alias("filled_at"),
    )


@_over_warehouse
def to_cents(wh):
    return wh.stg_claims.select("claim_id", "price_cents", "pbm_fee_cents")


def _safe_ratio(wh):
    by_site = wh.stg_claims.groupBy("npi").agg(
        F.count("*").alias("claims"), F.count_if(F.col("quantity") < 0).alias("bad_quantities")
    )
    return by_site.withColumn("claims_per_bad_quantity", safe_ratio("claims", "bad_quantities"))


_over_warehouse(_safe_ratio, "safe_ratio")

# Classification.


@_over_warehouse
def dq_classify_claims(wh):
    return wh.stg_claims.select(
        "claim_id", "price_raw", "quantity_raw", "timestamp_raw", "id_occurrences", "dq_reject_reason"
    )


@_over_warehouse
def dq_classify_reverts(wh):
    return wh.stg_reverts.select("revert_id", "claim_id", "reverted_at", "id_occurrences", "dq_reject_reason")


@_over_warehouse
def dq_classify_lookups(wh):
    return wh.stg_lookups.select("lookup_id", "claim_id", "ndc", "looked_up_at", "lookup_date", "dq_reject_reason")


@_over_warehouse
def duplicate_ids(wh):
    return repeated_ids(wh.raw["claims"].select(clean_text("id").alias("claim_id")), "claim_id")


@_over_warehouse
def default_members(wh):
    return wh.stg_lookups.select("lookup_id", "partner", "channel", "partner_was_missing")


# Models.


_over_warehouse(lambda wh: wh.stg_partners, "fee_terms")
_over_warehouse(lambda wh: wh.dim_partner, "dim_partner")
_over_warehouse(lambda wh: wh.dim_pharmacy, "dim_site")
_over_warehouse(lambda wh: wh.stg_price_history, "price_history")
_over_warehouse(lambda wh: wh.claims_scoped, "scope_claims")
_over_warehouse(lambda wh: wh.reverts_scoped, "scope_reverts")
_over_warehouse(lambda wh: wh.lookups_resolved, "resolve_lookups")
_over_warehouse(lambda wh: wh.claim_attribution, "attribution")
_over_warehouse(lambda wh: wh.claim_revert, "first_revert")
_over_warehouse(lambda wh: wh.claim_cost, "asof_cost")
_over_warehouse(
    lambda wh: economics.with_cost(
        wh.analysable.drop("dq_reject_reason", "scope_exclusion_reason", "chain"),
        wh.stg_price_history,
        interval_left_join,
        wh.parts,
        # Of the claims before they are judged: those are shuffled for it, these are not.
        seen=staging.typed_claims(wh.raw["claims"]),
    ),
    "interval_cost",
)
_over_warehouse(
    lambda wh: economics.fee_economics(
        wh.analysable, economics.attribution(wh.clean_lookups, wh.parts), wh.stg_partners
    ),
    "fee_split",
)
_over_warehouse(lambda wh: wh.fct_claim, "fact_claim")
_over_warehouse(lambda wh: wh.fct_lookup, "fact_lookup")
_over_warehouse(lambda wh: wh.dim_drug, "dim_item")
_over_warehouse(lambda wh: wh.dim_date, "dim_date")
_over_warehouse(lambda wh: wh.dq_rejects, "quarantine")
_over_warehouse(lambda wh: wh.mart_partner_performance, "partner_performance")
_over_warehouse(
    # An average of doubles depends on the order of addition in its last digits; the comparison is to six decimals.
    lambda wh: wh.mart_drug_economics.withColumn(
        "avg_unit_cost_usd", F.round(F.col("avg_unit_cost_usd") * 1_000_000) / 1_000_000
    ),
    "drug_economics",
)
_over_warehouse(lambda wh: wh.mart_funnel_daily, "funnel_daily")


@_over_warehouse
def defect_class(wh):
    return wh.dq_rejects.groupBy("defect_class", "reject_reason").agg(F.count("*").alias("rows"))


# Scenarios.

_over_warehouse(
    lambda wh: scenarios.partner_terms(wh.claim_outcome, wh.stg_partners, "3-MEDIUM", 0.5), "scenario_partner_terms"
)
_over_warehouse(
    lambda wh: scenarios.reprice_band(wh.claim_outcome, wh.stg_partners, 1_000_000, 0.05), "scenario_reprice_band"
)
GRID = [n / 40 for n in range(1, 21)]
"""Rates of the scenario grids."""
_over_warehouse(lambda wh: grid.partner_terms_grid(wh.claim_outcome, wh.stg_partners, "3-MEDIUM", GRID), "scenario_terms_grid")
_over_warehouse(lambda wh: grid.reprice_band_grid(wh.claim_outcome, wh.stg_partners, 1_000_000, GRID), "scenario_reprice_grid")
_over_warehouse(lambda wh: scenarios.channel_levers(wh.claim_outcome, wh.fct_lookup), "channel_levers")

# Reports. Those that show no cost read the claims without it.

_over_warehouse(lambda wh: reports.partners_in_chain(wh.claim_outcome, "asia"), "partners_in_chain")
_over_warehouse(lambda wh: reports.headline_totals(wh.fct_claim), "headline_totals")
_over_warehouse(lambda wh: reports.reject_summary(wh.dq_rejects), "reject_summary")
_over_warehouse(lambda wh: reports.reject_share(wh.dq_rejects), "reject_share")
_over_warehouse(lambda wh: reports.reject_audit(wh.dq_rejects), "reject_audit")
_over_warehouse(lambda wh: reports.value_bands(wh.claim_outcome), "value_bands")
_over_warehouse(lambda wh: reports.weekly_reversal_rate(wh.mart_funnel_daily), "weekly_reversal_rate")
_over_warehouse(lambda wh: reports.reversal_cost(wh.claim_outcome), "reversal_cost")
_over_warehouse(
    lambda wh: reports.weekly_distinct_checked(marts.sketches_daily(wh.claim_outcome), wh.claim_outcome), "distinct_sketches"
)
_over_warehouse(
    lambda wh: reports.median_hours_checked(marts.sketches_daily(wh.claim_outcome), wh.claim_outcome), "quantile_sketches"
)
_over_warehouse(lambda wh: reports.cross_month_reversals(wh.claim_outcome), "cross_month_reversals")
_over_warehouse(lambda wh: reports.top_generic_savings(wh.mart_drug_economics), "top_generic_savings")
_over_warehouse(lambda wh: reports.chain_partner_pivot(wh.claim_outcome, views.PIVOT_COLUMNS), "chain_partner_pivot")
_over_warehouse(lambda wh: reports.fee_mix_long(wh.mart_partner_performance), "fee_mix_long")
_over_warehouse(lambda wh: reports.partner_ranking(wh.mart_partner_performance), "partner_ranking")
_over_warehouse(lambda wh: reports.partner_quality(wh.mart_partner_performance), "partner_quality")
_over_warehouse(lambda wh: reports.price_fee_points(wh.claim_outcome), "price_fee_points")

# Checks: every declared table of the warehouse, plus one table each that is known not to be clean. A table that several
# checks read is kept by Spark once it has been computed, with the columns they read and no others: each of the wide
# event tables would take as much memory and disk as the input. A table that is read once or twice is computed again.

RAW_TEXTS = ["price_raw", "quantity_raw", "pbm_fee_raw", "timestamp_raw", "id_occurrences"]
"""Columns of the judged claims that only the quarantine and the staging checks read."""
FACT_KEYS = ["claim_id", "pharmacy_npi", "partner", "ndc", "filled_date"]


def declared(name: str) -> dict[str, checks.TableChecks]:
    """The declarations of all tables that have any of the named kind."""
    return {t: c for layer in checks.ALL for t, c in layer.items() if getattr(c, name)}


@_over_warehouse
def key_violations(wh):
    every = {t: c for layer in checks.ALL for t, c in layer.items()}
    raw_ids = violation_count("raw_claims.id.unique", repeated_keys(wh.raw["claims"], ["id"]))
    wh.dq_rejects  # the quarantine reads the raw texts, so it is planned before the claims lose them
    wh.put("claims_judged", wh.claims_judged.drop(*RAW_TEXTS).persist())
    for name in every:
        getattr(wh, name)  # planned over the whole fact, before its checked columns take its place
    wh.put("fct_claim", wh.fct_claim.select(*every["fct_claim"].not_null).persist())
    return checks.union([*checks.key_checks(wh, every), raw_ids])


@_over_warehouse
def enum_violations(wh):
    unlisted = {"lookups.channel.accepted": checks.unlisted("channel", ["integration", "website"])}
    found = [*checks.enum_checks(wh, declared("accepted")), count_violations(wh.stg_lookups, unlisted)]
    return checks.union(found)


@_over_warehouse
def fk_violations(wh):
    wh.put("fct_claim", wh.fct_claim.select(*FACT_KEYS).persist())
    orphans = unreferenced(wh.stg_reverts, "claim_id", wh.fct_claim, "claim_id")
    return checks.union(
        [
            *checks.reference_checks(wh, declared("references")),
            violation_count("stg_reverts.claim_id.references.fct_claim", orphans),
        ]
    )


_over_warehouse(lambda wh: checks.row_conservation(wh), "row_conservation")
_over_warehouse(checks.rejection_rates, "rejection_rate")
_over_warehouse(lambda wh: count_violations(wh.fct_claim, checks.split_predicates()), "split_violations")
_over_warehouse(lambda wh: count_violations(wh.fct_claim, checks.net_zero_predicates()), "net_zero_violations")

# The same operators over another table.


@_over_events
def asof_events(events):
    """Each purchase with the last view of the same user at or before it."""
    viewed = events.where("event_type = 'view'")
    views_ = one_per_key(viewed, ["user_id", "ts"], [F.col("event_id")]).select(
        "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value")
    )
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof_left_join(
        purchases,
        views_,
        "user_id",
        "ts",
        "view_ts",
        ["view_value"],
        bucket=F.to_date,
    )


@_over_events
def first_event_per_user(events):
    return earliest_with_count(events, ["user_id"], ["ts", "event_id"], ["event_type"], "event_count")


@_over_events
def event_calendar(events):
    """Every day of the period with its attributes and its events, zero included."""
    per_day = events.groupBy(F.col("ts").cast("date").alias("date_day")).agg(F.count("*").alias("events"))
    bounds = per_day.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last"))
    days = with_calendar(calendar(bounds, "first", "last"), "date_day")
    counted = attach(days, per_day, "date_day")
    return counted.withColumn("events", F.coalesce("events", F.lit(0).cast("bigint")))


@_over_events
def hours_between_events(events):
    span = events.groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return span.select(
        "user_id",
        hours_crossed("first", "last").alias("hours_crossed"),
        minutes_crossed("first", "last").alias("minutes_crossed"),
    )
