"""Typed rows with a reject reason (D1-D5). Each function reads one source and joins no other. ``parts``: see
:func:`claimloom.operators.joins.spread`.

The order of the rules is the policy: the first rule that holds names the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import (
    clean_text,
    lower_text,
    or_default,
    parse_bigint,
    parse_double,
    parse_timestamp,
    parse_us_date,
    to_cents,
    upper_text,
)
from claimloom.operators.classify import Rule, any_null, first_match, occurrences, relabel, with_repeats
from claimloom.operators.joins import spread
from claimloom.operators.temporal import one_per_key
from claimloom.sources.arrays import CORRUPT

# Reasons, in rule order.
CLAIM_REASONS = [
    "missing_required_field",
    "unparseable_number",
    "unparseable_timestamp",
    "non_positive_amount",
    "duplicate_claim_id",
]
REVERT_REASONS = ["missing_required_field", "unparseable_timestamp", "duplicate_revert_id"]
LOOKUP_REASONS = ["missing_required_field", "unparseable_timestamp"]
DRUG_CLASSES = {"B": "brand", "G": "generic"}


def readable(raw: DataFrame) -> DataFrame:
    """The landed rows but unreadable records, which go to the quarantine as they are."""
    return raw.where(F.col(CORRUPT).isNull()) if CORRUPT in raw.columns else raw


def typed_claims(raw: DataFrame) -> DataFrame:
    """Every readable claim with its typed columns, not judged."""
    return readable(raw).select(
        clean_text("id").alias("claim_id"),
        clean_text("npi").alias("npi"),
        clean_text("ndc").alias("ndc"),
        parse_timestamp("timestamp").alias("filled_at"),
        parse_double("price").alias("price"),
        parse_double("pbm_fee").alias("pbm_fee"),
        parse_double("quantity").alias("quantity"),
        F.col("price").alias("price_raw"),
        F.col("quantity").alias("quantity_raw"),
        F.col("pbm_fee").alias("pbm_fee_raw"),
        F.col("timestamp").alias("timestamp_raw"),
        "_source_file",
    ).withColumns(
        {
            "filled_date": F.col("filled_at").cast("date"),
            "price_cents": to_cents("price"),
            "pbm_fee_cents": to_cents("pbm_fee"),
        }
    )


def claims(raw: DataFrame, parts: int | None = None) -> DataFrame:
    typed = typed_claims(raw)
    missing = any_null("claim_id", "npi", "ndc", "price_raw", "quantity_raw", "pbm_fee_raw", "timestamp_raw")
    # An amount too large for bigint cents is as unreadable as a word.
    unreadable = any_null("price_cents", "pbm_fee_cents", "quantity")
    rules = zip(CLAIM_REASONS[:-1], [missing, unreadable, "filled_at IS NULL", "price <= 0 OR quantity <= 0"])
    # Counted over all rows: a clean row whose twin is malformed is ambiguous too.
    return _judged(typed, "claim_id", list(rules), CLAIM_REASONS[-1], parts).select(
        "claim_id",
        "npi",
        "ndc",
        "filled_at",
        "filled_date",
        "price_cents",
        "pbm_fee_cents",
        "quantity",
        "price_raw",
        "quantity_raw",
        "pbm_fee_raw",
        "timestamp_raw",
        "id_occurrences",
        "_source_file",
        "dq_reject_reason",
    )


def _judged(typed: DataFrame, key: str, rules: list[Rule], repeated: str, parts: int | None) -> DataFrame:
    """Add the occurrences of the id and the reason of a row: the first rule that holds, else ``repeated``.

    The rules are tried before the rows are shuffled, so that what only they read need not be. A row without an id must
    have a reason by ``rules``.
    """
    early = with_repeats(typed.withColumn("__early", first_match(rules)), key, "__repeats", parts)
    return early.withColumns(
        {
            "id_occurrences": occurrences(typed, key, "__repeats"),
            "dq_reject_reason": F.coalesce("__early", first_match([(repeated, "__repeats > 1")])),
        }
    )


def reverts(raw: DataFrame, parts: int | None = None) -> DataFrame:
    typed = readable(raw).select(
        clean_text("id").alias("revert_id"),
        clean_text("claim_id").alias("claim_id"),
        parse_timestamp("timestamp").alias("reverted_at"),
        F.col("timestamp").alias("timestamp_raw"),
        "_source_file",
    )
    rules = zip(
        REVERT_REASONS[:-1], [any_null("revert_id", "claim_id", "timestamp_raw"), "reverted_at IS NULL"]
    )
    return _judged(typed, "revert_id", list(rules), REVERT_REASONS[-1], parts).select(
        "revert_id",
        "claim_id",
        "reverted_at",
        "timestamp_raw",
        "id_occurrences",
        "_source_file",
        "dq_reject_reason",
    )


def lookups(raw: DataFrame) -> DataFrame:
    """A lookup without partner or channel is kept under ``unknown``: it is a real event of the funnel."""
    rules = zip(
        LOOKUP_REASONS,
        [any_null("lookup_id", "ndc", "timestamp_raw"), "looked_up_at IS NULL"],
    )
    return readable(raw).select(
        clean_text("id").alias("lookup_id"),
        clean_text("claim_id").alias("claim_id"),
        clean_text("ndc").alias("ndc"),
        or_default("nullif(trim(partner), '')", "unknown").alias("partner"),
        or_default("lower(nullif(trim(channel), ''))", "unknown").alias("channel"),
        parse_timestamp("timestamp").alias("looked_up_at"),
        parse_timestamp("timestamp").cast("date").alias("lookup_date"),
        clean_text("partner").isNull().alias("partner_was_missing"),
        F.col("timestamp").alias("timestamp_raw"),
        "_source_file",
    ).withColumn("dq_reject_reason", first_match(list(rules)))


def pharmacies(raw: DataFrame) -> DataFrame:
    """One row per npi; of several, the first chain in order, a blank chain last."""
    cleaned = raw.select(
        clean_text("npi").alias("npi"), lower_text("chain").alias("chain"), "_source_file"
    ).where(F.col("npi").isNotNull())
    first = one_per_key(cleaned, ["npi"], [F.col("chain").asc_nulls_last(), F.col("_source_file")])
    return first.withColumn("chain", or_default("chain", "unknown"))


def partners(raw: DataFrame) -> DataFrame:
    """Commercial terms. A flat fee of 0 is a value, not a gap; percentages become rates of 0 to 1."""
    flat = parse_bigint("fee_cents")
    share = parse_double("fee_percentage")
    model = F.when(flat.isNotNull(), "flat").when(share.isNotNull(), "percentage").otherwise("unknown")
    return raw.select(
        clean_text("partner").alias("partner"),
        flat.alias("flat_fee_cents"),
        (share / 100).alias("fee_rate"),
        model.alias("fee_model"),
        "_source_file",
    ).where(F.col("partner").isNotNull())


def price_history(raw: DataFrame, parts: int | None = None) -> DataFrame:
    """One unit price per (ndc, effective_date): the one confirmed last. Rates stay unrounded doubles."""
    typed = raw.select(
        clean_text("ndc").alias("ndc"),
        F.trim("ndc_description").alias("ndc_description"),
        parse_double("unit_price").alias("unit_cost_usd"),
        parse_double("generic_unit_price").alias("generic_unit_cost_usd"),
        parse_us_date("effective_date").alias("effective_date"),
        parse_us_date("as_of_date").alias("as_of_date"),
        upper_text("pricing_unit").alias("pricing_unit"),
        relabel("upper(trim(classification))", DRUG_CLASSES, "unknown").alias("drug_class"),
        (upper_text("otc") == "Y").alias("is_otc"),
    )
    usable = typed.where(
        F.col("ndc").isNotNull() & F.col("effective_date").isNotNull() & (F.col("unit_cost_usd") > 0)
    )
    # Every column takes part in the order, so which of several same-day confirmations stays is no accident.
    rest = [c for c in usable.columns if c not in ("ndc", "effective_date", "as_of_date")]
    latest_first = [F.col("as_of_date").desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in rest)]
    # Shuffled by the item alone: what reads an item's history in time order finds it in place.
    return one_per_key(spread(usable, "ndc", parts), ["ndc", "effective_date"], latest_first)
