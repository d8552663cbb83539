"""Scope, attribution, reversals, cost and fee split, on fabricated rows."""

import datetime as dt

import pytest
from conftest import rows

from claimloom.plans import economics, facts, scope

D = dt.date
STAGED = "claim_id string, npi string, dq_reject_reason string"


def at(*args):
    return dt.datetime(*args)


def test_claims_of_unknown_pharmacies_are_out_of_scope(frame):
    staged = frame(STAGED, [("known", "1", None), ("unknown", "9", None), ("malformed", "9", "unparseable_number")])
    judged = scope.judge_claims(staged, frame("npi string, chain string", [("1", "asia")]))
    assert rows(scope.claims_scoped(judged), "claim_id", "scope_exclusion_reason") == [
        ("known", None),
        ("unknown", "unknown_npi"),
    ]
    assert rows(scope.analysable(judged), "claim_id", "chain") == [("known", "asia")]
    assert rows(judged.where("dq_reject_reason is not null"), "scope_exclusion_reason") == [(None,)]


def test_reverts_without_analysable_claim_are_orphans(frame):
    staged = frame(
        "revert_id string, claim_id string, dq_reject_reason string",
        [("a", "present", None), ("b", "never_landed", None), ("c", None, "missing_required_field")],
    )
    hub = frame("claim_id string", [("present",)])
    judged = scope.judge_reverts(staged, hub)
    assert rows(scope.reverts_scoped(judged), "revert_id", "scope_exclusion_reason") == [("a", None), ("b", "orphan_claim_id")]
    assert judged.count() == 3


def test_lookups_lose_the_link_not_the_row(frame):
    staged = frame(
        "lookup_id string, claim_id string, ndc string, partner string, channel string, looked_up_at timestamp_ntz, "
        "lookup_date date, partner_was_missing boolean, timestamp_raw string, _source_file string, dq_reject_reason string",
        [
            (i, c, "n", "p", "ch", at(2026, 5, 1), D(2026, 5, 1), False, "t", "f", None)
            for i, c in [("1", "known"), ("2", "gone"), ("3", None), ("4", None)]
        ],
    )
    got = scope.lookups_resolved(staged, frame("claim_id string", [("known",)]))
    assert rows(got, "lookup_id", "claim_id", "converted", "has_unresolvable_claim_id") == [
        ("1", "known", True, False),
        ("2", None, False, True),
        ("3", None, False, False),
        ("4", None, False, False),
    ]


def test_earliest_lookup_originates_the_claim(frame):
    lookups = frame(
        "lookup_id string, claim_id string, partner string, channel string, looked_up_at timestamp_ntz",
        [
            ("2", "c", "late", "website", at(2026, 5, 2)),
            ("9", "c", "tie", "website", at(2026, 5, 1)),
            ("1", "c", "first", "integration", at(2026, 5, 1)),
            ("3", None, "none", "website", at(2026, 1, 1)),
        ],
    )
    assert rows(economics.attribution(lookups), "claim_id", "partner", "attributing_lookup_id", "attributing_lookup_count") == [
        ("c", "first", "1", 3)
    ]


def test_earliest_reversal_counts(frame):
    reverts = frame(
        "revert_id string, claim_id string, reverted_at timestamp_ntz",
        [("b", "c", at(2026, 5, 2)), ("a", "c", at(2026, 5, 1)), ("z", "d", at(2026, 6, 1))],
    )
    assert rows(economics.first_reverts(reverts)) == [("c", at(2026, 5, 1), "a", 2), ("d", at(2026, 6, 1), "z", 1)]


TERMS = [("flat", "flat", 65, None), ("share", "percentage", None, 0.25), ("part", "percentage", None, 0.61), ("free", "flat", 0, None), ("odd", "unknown", None, None)]
TERM_SCHEMA = "partner string, fee_model string, flat_fee_cents bigint, fee_rate double"


@pytest.mark.parametrize(
    "partner, fee, model, paid, kept, capped, shortfall",
    [
        ("flat", 240, "flat", 65, 175, False, 0),
        ("flat", 65, "flat", 65, 0, False, 0),
        ("flat", 64, "flat", 64, 0, True, 1),
        ("flat", 0, "flat", 0, 0, True, 65),
        ("flat", -15, "flat", -15, 0, True, 80),
        ("share", 240, "percentage", 60, 180, False, 0),
        ("share", 1, "percentage", 0, 1, False, 0),
        ("share", 2, "percentage", 1, 1, False, 0),
        ("part", 57, "percentage", 35, 22, False, 0),
        ("free", 333, "flat", 0, 333, False, 0),
        ("odd", 333, "unknown", 0, 333, False, 0),
        ("unknown", 333, "none", 0, 333, False, 0),
        (None, 333, "none", 0, 333, False, 0),
    ],
)
def test_fee_split(frame, partner, fee, model, paid, kept, capped, shortfall):
    claims = frame("claim_id string, pbm_fee_cents bigint", [("c", fee)])
    origin = frame("claim_id string, partner string", [("c", partner)] if partner else [("other", "flat")])
    got = economics.fee_economics(claims, origin, frame(TERM_SCHEMA, TERMS)).first()
    assert got.partner == (partner or "direct")
    assert (got.fee_model, got.partner_fee_cents, got.retained_fee_cents) == (model, paid, kept)
    assert (got.partner_fee_was_capped, got.capped_shortfall_cents) == (capped, shortfall)
    assert got.partner_fee_cents + got.retained_fee_cents == fee


PRICES = "ndc string, effective_date date, unit_cost_usd double, generic_unit_cost_usd double, ndc_description string, drug_class string, pricing_unit string, is_otc boolean"


def price(ndc, day, rate, generic=None, cls="brand"):
    return (ndc, day, rate, generic, "item", cls, "EA", False)


HISTORY = [price("1", D(2025, 9, 10), 0.4), price("1", D(2025, 10, 20), 1.25, 0.75), price("1", D(2025, 12, 2), 0.9)]


@pytest.mark.parametrize(
    "ndc, day, quantity, rate, cents",
    [
        ("1", D(2025, 11, 5), 12.0, 1.25, 1500),
        ("1", D(2025, 10, 20), 2.0, 1.25, 250),
        ("1", D(2025, 10, 19), 2.0, 0.4, 80),
        ("1", D(2029, 1, 1), 4.0, 0.9, 360),
        ("1", D(2025, 9, 9), 2.0, None, None),
        ("8", D(2025, 11, 5), 2.0, None, None),
    ],
)
def test_cost_is_the_price_in_force_on_the_fill_date(frame, ndc, day, quantity, rate, cents):
    claims = frame("claim_id string, ndc string, filled_date date, quantity double", [("c", ndc, day, quantity)])
    got = economics.with_cost(claims, frame(PRICES, HISTORY)).collect()
    assert len(got) == 1
    assert (got[0].unit_cost_usd, got[0].est_acquisition_cost_cents) == (rate, cents)
    assert got[0].cost_basis == ("no_match" if rate is None else "as_of_fill_date")
    assert got[0].has_cost_match is (rate is not None)


def test_rate_is_rounded_after_the_multiplication(frame):
    claims = frame("claim_id string, ndc string, filled_date date, quantity double", [("c", "1", D(2025, 5, 1), 45.0)])
    got = economics.with_cost(claims, frame(PRICES, [price("1", D(2025, 1, 1), 0.13478)])).first()
    assert got.est_acquisition_cost_cents == 607  # 45 times the rate rounded to 0.13 would be 585


def test_a_cost_too_large_for_cents_is_no_match(frame):
    claims = frame("claim_id string, ndc string, filled_date date, quantity double", [("c", "1", D(2025, 5, 1), 1e12)])
    got = economics.with_cost(claims, frame(PRICES, [price("1", D(2025, 1, 1), 1e9)])).first()
    assert (got.est_acquisition_cost_cents, got.has_cost_match, got.cost_basis) == (None, False, "no_match")


def test_a_later_price_never_changes_an_earlier_cost(frame):
    claims = frame("claim_id string, ndc string, filled_date date, quantity double", [("c", "1", D(2025, 11, 5), 12.0)])
    before = rows(economics.with_cost(claims, frame(PRICES, HISTORY)))
    later = [*HISTORY, price("1", D(2025, 11, 6), 77.0)]
    assert rows(economics.with_cost(claims, frame(PRICES, later))) == before


def test_claim_fact_nets_out_reversals_and_keeps_unknown_margin_null(frame):
    hub = frame(
        "claim_id string, npi string, chain string, ndc string, filled_at timestamp_ntz, filled_date date, quantity double, "
        "price_cents bigint, pbm_fee_cents bigint, _source_file string",
        [
            ("kept", "1", "asia", "1", at(2025, 11, 5, 10, 59), D(2025, 11, 5), 16.0, 5000, 465, "f"),
            ("back", "1", "asia", "9", at(2025, 11, 5, 10, 59), D(2025, 11, 5), 16.0, 7000, 700, "f"),
        ],
    )
    origin = frame(
        "claim_id string, partner string, channel string, attributing_lookup_id string, looked_up_at timestamp_ntz",
        [("kept", "flat", "website", "L", at(2025, 11, 5, 10, 0)), ("elsewhere", "flat", "x", "M", at(2026, 4, 1))],
    )
    back = frame(
        "claim_id string, reverted_at timestamp_ntz, revert_id string",
        [("back", at(2025, 11, 5, 11, 1), "R"), ("orphan", at(2026, 1, 1), "S")],
    )
    outcome = facts.claim_outcome(hub, origin, frame(TERM_SCHEMA, TERMS), back)
    got = {r.claim_id: r for r in facts.claim_fact(outcome, frame(PRICES, HISTORY)).collect()}
    assert set(got) == {"kept", "back"}
    kept, reverted = got["kept"], got["back"]
    assert (kept.partner, kept.channel, kept.minutes_lookup_to_fill, kept.hours_to_revert) == ("flat", "website", 59, None)
    assert (kept.pharmacy_margin_cents, kept.generic_substitution_savings_cents) == (5000 - 2000 - 465, 2000 - 1200)
    assert (kept.net_price_cents, kept.net_retained_cents, kept.net_claim_count) == (5000, 400, 1)
    assert (reverted.partner, reverted.channel, reverted.is_reverted, reverted.hours_to_revert) == ("direct", "direct", True, 1)
    assert reverted.pharmacy_margin_cents is None
    assert [reverted[c] for c in reverted.asDict() if c.startswith("net_")] == [0, 0, 0, 0, 0]
    assert reverted.retained_fee_cents == 700

    lookups = frame(
        "lookup_id string, claim_id string, ndc string, partner string, channel string, looked_up_at timestamp_ntz, "
        "lookup_date date, partner_was_missing boolean, _source_file string",
        [(i, c, "1", "flat", "website", at(2026, 4, 15), D(2026, 4, 15), False, "f") for i, c in [("L", "kept"), ("M", "gone"), ("N", None), ("O", "back")]],
    )
    fact = facts.lookup_fact(lookups, outcome)
    assert rows(fact, "lookup_id", "claim_id", "converted", "has_unresolvable_claim_id", "converted_and_reverted", "net_retained_cents") == [
        ("L", "kept", True, False, False, 400),
        ("M", None, False, True, False, 0),
        ("N", None, False, False, False, 0),
        ("O", "back", True, False, True, 0),
    ]
