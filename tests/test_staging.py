"""Quarantine reasons, their order, duplicates and reference data."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom.operators.classify import first_match, relabel, with_occurrences, with_repeats
from claimloom.operators.joins import attach
from claimloom.plans import quarantine, staging

CLAIM = "id string, npi string, ndc string, price string, quantity string, pbm_fee string, timestamp string, _source_file string"
STAMP = "2026-05-01T10:00:00"


def claim(id="a", npi="1", ndc="00000417", price="6.15", quantity="30", pbm_fee="2.48", timestamp=STAMP):
    return (id, npi, ndc, price, quantity, pbm_fee, timestamp, "f.json")


def reasons(df):
    return {r.claim_id: r.dq_reject_reason for r in df.collect()}


def test_each_defect_has_its_reason(frame):
    raw = frame(
        CLAIM,
        [
            claim("clean"),
            claim("no_ndc", ndc=None),
            claim("blank_npi", npi="  "),
            claim("no_price", price=None),
            claim("blank_price", price=""),
            claim("words", price="one hundred"),
            claim("nan", quantity="NaN"),
            claim("huge", price="1e30"),
            claim("stamp", timestamp="2025-02-31T27:61:00"),
            claim("blank_stamp", timestamp=""),
            claim("negative", price="-5"),
            claim("zero_quantity", quantity="0"),
            claim("negative_fee", pbm_fee="-1"),
            claim(None),
            claim(" "),
        ],
    )
    got = staging.claims(raw)
    assert reasons(got.where("claim_id is not null")) == {
        "clean": None,
        "no_ndc": "missing_required_field",
        "blank_npi": "missing_required_field",
        "no_price": "missing_required_field",
        "blank_price": "unparseable_number",
        "words": "unparseable_number",
        "nan": "unparseable_number",
        "huge": "unparseable_number",
        "stamp": "unparseable_timestamp",
        "blank_stamp": "unparseable_timestamp",
        "negative": "non_positive_amount",
        "zero_quantity": "non_positive_amount",
        "negative_fee": None,
    }
    without_id = got.where("claim_id is null")
    assert rows(without_id, "dq_reject_reason", "id_occurrences") == [("missing_required_field", 2)] * 2


def test_precedence(frame):
    raw = frame(CLAIM, [claim(price="x", quantity="-1", timestamp="never")])
    assert reasons(staging.claims(raw)) == {"a": "unparseable_number"}


def test_both_sides_of_a_duplicate(frame):
    raw = frame(CLAIM, [claim("d", price="10.00"), claim("d", price="2148.39"), claim("e")])
    got = staging.claims(raw)
    assert rows(got, "claim_id", "price_cents", "id_occurrences", "dq_reject_reason") == [
        ("d", 1000, 2, "duplicate_claim_id"),
        ("d", 214839, 2, "duplicate_claim_id"),
        ("e", 615, 1, None),
    ]


def test_twin_of_a_malformed_row_is_a_duplicate(frame):
    got = staging.claims(frame(CLAIM, [claim("d"), claim(" d ", price="x")]))
    assert sorted(r.dq_reject_reason for r in got.collect()) == ["duplicate_claim_id", "unparseable_number"]


def test_order_of_rows_changes_nothing_and_a_copy_moves_two_rows(frame):
    clean = [claim(f"c{i}", price=str(i + 1)) for i in range(40)]
    before = rows(staging.claims(frame(CLAIM, clean)))
    shuffled = random.Random(1).sample(clean, len(clean))
    assert rows(staging.claims(frame(CLAIM, shuffled))) == before
    after = reasons(staging.claims(frame(CLAIM, [*clean, claim("c7", price="99")])))
    assert [k for k, v in after.items() if v] == ["c7"]
    assert staging.claims(frame(CLAIM, [*clean, claim("c7", price="99")])).where("dq_reject_reason is null").count() == 39


def test_reverts(frame):
    raw = frame(
        "id string, claim_id string, timestamp string, _source_file string",
        [
            ("ok", "c", STAMP, "f"),
            ("gone", " ", STAMP, "f"),
            ("bad", "c", "x", "f"),
            ("twice", "c", STAMP, "f"),
            ("twice", "d", STAMP, "f"),
        ],
    )
    assert rows(staging.reverts(raw), "revert_id", "dq_reject_reason") == [
        ("bad", "unparseable_timestamp"),
        ("gone", "missing_required_field"),
        ("ok", None),
        ("twice", "duplicate_revert_id"),
        ("twice", "duplicate_revert_id"),
    ]


def test_lookups_get_named_members_not_rejections(frame):
    raw = frame(
        "id string, claim_id string, ndc string, partner string, channel string, timestamp string, _source_file string",
        [
            ("1", "c", "n", "P", " APP ", STAMP, "f"),
            ("2", None, "n", " ", "", STAMP, "f"),
            ("3", None, None, "P", "fax", STAMP, "f"),
            ("4", None, "n", "P", "fax", "x", "f"),
        ],
    )
    got = staging.lookups(raw)
    assert rows(got, "lookup_id", "partner", "channel", "partner_was_missing", "dq_reject_reason") == [
        ("1", "P", "app", False, None),
        ("2", "unknown", "unknown", True, None),
        ("3", "P", "fax", False, "missing_required_field"),
        ("4", "P", "fax", False, "unparseable_timestamp"),
    ]


def test_pharmacies_are_one_per_npi_and_a_blank_chain_sorts_last(frame):
    raw = frame(
        "npi string, chain string, _source_file string",
        [("1", " ", "f"), ("1", "Zeta", "f"), ("2", "B", "f"), ("2", "A", "g"), ("3", "", "f"), (" ", "A", "f")],
    )
    assert rows(staging.pharmacies(raw), "npi", "chain") == [("1", "zeta"), ("2", "a"), ("3", "unknown")]


def test_partner_terms_test_for_null_not_for_zero(frame):
    raw = frame(
        "partner string, fee_cents string, fee_percentage string, _source_file string",
        [("free", "0", None, "f"), ("half", None, "50.0", "f"), ("flat", "100.0", "", "f"), ("none", "", "", "f"), (" ", "1", "", "f")],
    )
    assert rows(staging.partners(raw), "partner", "flat_fee_cents", "fee_rate", "fee_model") == [
        ("flat", 100, None, "flat"),
        ("free", 0, None, "flat"),
        ("half", None, 0.5, "percentage"),
        ("none", None, None, "unknown"),
    ]


def test_price_history_keeps_the_latest_confirmation(frame):
    def price(ndc, rate, effective, as_of, cls="G"):
        return (ndc, " item ", rate, effective, as_of, " ea", cls, "y", None)

    raw = frame(
        "ndc string, ndc_description string, unit_price string, effective_date string, as_of_date string, "
        "pricing_unit string, classification string, otc string, generic_unit_price string",
        [
            price("1", "1.0", "03/04/2026", "03/11/2026"),
            price("1", "1.5", "3/4/2026", "3/18/2026", "b"),
            price("1", "2.0", "04/01/2026", "04/08/2026", None),
            price("1", "0", "05/01/2026", "05/08/2026"),
            price("1", "3", "2026-05-01", "05/08/2026"),
            price(" ", "3", "05/01/2026", "05/08/2026"),
        ],
    )
    got = staging.price_history(raw)
    assert rows(got, "ndc", F.col("effective_date").cast("string"), "unit_cost_usd", "drug_class", "pricing_unit", "is_otc") == [
        ("1", "2026-03-04", 1.5, "brand", "EA", True),
        ("1", "2026-04-01", 2.0, "unknown", "EA", True),
    ]


def test_every_reason_has_a_class():
    assert set(quarantine.REASONS) == set(quarantine.DEFECT_CLASSES)


@pytest.mark.parametrize("value, expected", [(1, "one"), (5, "small"), (50, None)])
def test_first_match(frame, value, expected):
    rules = [("one", "x = 1"), ("small", "x < 10")]
    assert frame("x int", [(value,)]).select(first_match(rules)).first()[0] == expected


def test_relabel_without_default_is_null(frame):
    df = frame("x string", [("A",), ("Z",), (None,)])
    assert rows(df.select(relabel("x", {"A": "first"}))) == sorted([("first",), (None,), (None,)], key=repr)


def test_payload_keeps_null_fields(frame):
    judged = staging.claims(frame(CLAIM, [claim(ndc=None)])).withColumn("scope_exclusion_reason", F.lit(None).cast("string"))
    row = quarantine.rejected("claims", judged).first()
    assert row.raw_payload == (
        '{"id":"a","npi":"1","ndc":null,"price":"6.15","quantity":"30","pbm_fee":"2.48","timestamp":"2026-05-01T10:00:00"}'
    )
    assert (row.detected_in, row.defect_class) == ("staging", "malformed")


def test_occurrences_count_rows_without_id_as_one_id(frame):
    df = frame("k string, n int", [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), (None, 6)])
    assert rows(with_occurrences(df, "k")) == sorted(
        [("a", 1, 2), ("a", 2, 2), ("b", 3, 1), (None, 4, 3), (None, 5, 3), (None, 6, 3)], key=repr
    )


def test_rows_stay_in_place_for_the_next_join_on_the_id(frame):
    """One shuffle each of the rows, their counts and the other table."""
    df = frame("k string, n int", [("a", 1), ("b", 2)])
    other = frame("k string, m int", [("a", 1)])
    plan = attach(with_repeats(df, "k"), other, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_raw_texts_are_not_shuffled_where_only_the_rules_read_them(spark):
    raw = spark.range(5).selectExpr(
        "string(id) id", "'1' npi", "'2' ndc", "string(id) price", "'1' quantity", "'1' pbm_fee",
        "'2026-01-01' timestamp", "'f' _source_file",
    )
    plan = staging.claims(raw).select("claim_id", "dq_reject_reason")._jdf.queryExecution().executedPlan().toString()
    assert "price_raw" not in plan
