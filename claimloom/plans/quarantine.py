"""Everything that was stopped, with reason, class and the text that arrived."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.classify import relabel
from claimloom.plans.staging import CLAIM_REASONS, LOOKUP_REASONS, REVERT_REASONS
from claimloom.sources.arrays import CORRUPT

# The class of every reason. There is no default, a new reason has to be listed.
UNREADABLE = "unreadable_record"
DEFECT_CLASSES = {
    UNREADABLE: "malformed",
    "missing_required_field": "malformed",
    "unparseable_number": "malformed",
    "unparseable_timestamp": "malformed",
    "non_positive_amount": "malformed",
    "duplicate_claim_id": "ambiguous",
    "duplicate_revert_id": "ambiguous",
    "unknown_npi": "out_of_scope",
    "orphan_claim_id": "out_of_scope",
}
REASONS = list(dict.fromkeys([UNREADABLE, *CLAIM_REASONS, *REVERT_REASONS, *LOOKUP_REASONS, "unknown_npi", "orphan_claim_id"]))

# Output field -> staged column, per source.
PAYLOADS = {
    "claims": {
        "id": "claim_id",
        "npi": "npi",
        "ndc": "ndc",
        "price": "price_raw",
        "quantity": "quantity_raw",
        "pbm_fee": "pbm_fee_raw",
        "timestamp": "timestamp_raw",
    },
    "reverts": {"id": "revert_id", "claim_id": "claim_id", "timestamp": "timestamp_raw"},
    "lookups": {
        "id": "lookup_id",
        "claim_id": "claim_id",
        "ndc": "ndc",
        "partner": "partner",
        "channel": "channel",
        "timestamp": "timestamp_raw",
    },
}


def rejected(source: str, judged: DataFrame) -> DataFrame:
    """The stopped rows of one source, malformed and out of scope alike, in one pass over it."""
    payload = PAYLOADS[source]
    scoped = "scope_exclusion_reason" in judged.columns
    reason = "coalesce(dq_reject_reason, scope_exclusion_reason)" if scoped else "dq_reject_reason"
    record = F.struct(*(F.col(column).alias(field) for field, column in payload.items()))
    return judged.where(f"{reason} IS NOT NULL").select(
        F.lit(source).alias("source_table"),
        F.expr("CASE WHEN dq_reject_reason IS NOT NULL THEN 'staging' ELSE 'intermediate' END AS detected_in"),
        F.col(payload["id"]).alias("record_id"),
        F.expr(reason).alias("reject_reason"),
        relabel(reason, DEFECT_CLASSES).alias("defect_class"),
        "_source_file",
        F.to_json(record, {"ignoreNullFields": "false"}).alias("raw_payload"),
    )


def unreadable(source: str, raw: DataFrame) -> DataFrame:
    """The landed records of one source that could not be read; the payload is their text."""
    return raw.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(source).alias("source_table"),
        F.lit("staging").alias("detected_in"),
        F.lit(None).cast("string").alias("record_id"),
        F.lit(UNREADABLE).alias("reject_reason"),
        F.lit(DEFECT_CLASSES[UNREADABLE]).alias("defect_class"),
        "_source_file",
        F.col(CORRUPT).alias("raw_payload"),
    )


def quarantine(
    judged_claims: DataFrame,
    judged_reverts: DataFrame,
    staged_lookups: DataFrame,
    raw: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``raw``: the landed event tables by source, for their unreadable records."""
    parts = [
        rejected("claims", judged_claims),
        rejected("reverts", judged_reverts),
        rejected("lookups", staged_lookups),
        *(unreadable(s, df) for s, df in (raw or {}).items() if CORRUPT in df.columns),
    ]
    return reduce(DataFrame.unionByName, parts)
