"""Checks are silent on clean rows and fire on seeded faults."""

from conftest import rows
from pyspark.sql import functions as F

from claimloom.operators import assertions as q
from claimloom.operators.reshape import pivot_sum, to_long, top, with_share_of_total
from claimloom.plans import checks, marts, reports, scenarios


def test_keys(frame):
    df = frame("a string, b int", [("x", 1), ("x", 2), ("y", 1), (None, 1), (None, 1)])
    assert rows(q.repeated_keys(df, ["a"])) == [("x", 2)]
    assert rows(q.repeated_keys(df, ["a"], where=F.col("b") == 1)) == []
    assert rows(q.repeated_keys(df, ["a", "b"])) == [(None, 1, 2)]
    assert q.null_rows(df, "a").count() == 2


def test_values_and_references(frame):
    df = frame("a string, b int", [("x", 1), ("z", 2), (None, 3)])
    assert rows(q.unaccepted(df, "a", ["x", "y"])) == [("z", 2)]
    assert rows(q.unaccepted(df, "a", ["x"], where=F.col("b") < 2)) == []
    assert rows(q.unreferenced(df, "a", frame("id string", [("x",), (None,)]), "id")) == [("z", 1)]


def test_counts_come_in_one_row_per_check(frame):
    df = frame("a int", [(1,), (None,), (3,)])
    got = q.count_violations(df, {"t.a.not_null": "a IS NULL", "t.a.small": "a > 5"})
    assert rows(got) == [("t.a.not_null", 1), ("t.a.small", 0)]
    assert rows(q.violation_count("c", df.where("a = 9"))) == [("c", 0)]


def test_split_and_net_checks_fire(frame):
    schema = "pbm_fee_cents bigint, partner_fee_cents bigint, retained_fee_cents bigint"
    good, lost, negative = (500, 100, 400), (500, 100, 399), (50, 100, -50)
    got = dict(rows(q.count_violations(frame(schema, [good, lost, negative]), checks.split_predicates())))
    assert got == {"split.reconciles": 1, "split.never_exceeds_fee": 1}
    nets = "is_reverted boolean, net_price_cents int, net_pbm_fee_cents int, net_partner_fee_cents int, net_retained_cents int, net_claim_count int"
    df = frame(nets, [(True, 0, 0, 0, 0, 0), (True, 0, 0, 0, 7, 1), (False, 9, 9, 9, 9, 1)])
    fired = {k for k, v in rows(q.count_violations(df, checks.net_zero_predicates())) if v}
    assert fired == {"reverted.net_retained_cents.is_zero", "reverted.net_claim_count.is_zero"}


def test_reshape(frame):
    df = frame("r string, c string, v bigint", [("a", "x", 1), ("a", "x", 2), ("b", "y", 5), ("b", "other", 9)])
    assert rows(pivot_sum(df, "r", "c", {"x": "col_x", "y": "col_y"}, "v")) == [("a", 3, None, None), ("b", None, 5, 9)]
    wide = frame("p string, m bigint, n bigint", [("a", 1, 2)])
    assert rows(to_long(wide, ["p"], ["m", "n"], "side", "cents")) == [("a", "m", 1), ("a", "n", 2)]
    assert [tuple(r) for r in top(df, [F.desc("v")], 2).collect()] == [("b", "other", 9), ("b", "y", 5)]
    shares = with_share_of_total(frame("g string, n bigint", [("a", 1567), ("b", 513), ("c", 307)]), "n", "pct")
    assert rows(shares, "g", "pct") == [("a", 65.6), ("b", 21.5), ("c", 12.9)]


def test_bands_are_half_open(frame):
    df = frame("c bigint", [(9_999,), (10_000,), (999_999,), (1_000_000,)])
    assert [r[0][0] for r in df.select(reports.value_band("c")).collect()] == ["1", "2", "2", "3"]


FACT = "partner string, price_cents bigint, pbm_fee_cents bigint, retained_fee_cents bigint, is_reverted boolean"
TERMS = "partner string, fee_model string, flat_fee_cents bigint, fee_rate double"


def test_scenarios_rerun_the_split(frame):
    facts = frame(
        FACT,
        [
            ("share", 2_000_000, 800, 160, False),
            ("share", 5_000, 700, 140, False),
            ("share", 2_000_000, 800, 160, True),
            ("flat", 2_000_000, 800, 700, False),
            ("direct", 5_000, 700, 700, False),
        ],
    )
    terms = frame(TERMS, [("share", "percentage", None, 0.8), ("flat", "flat", 100, None)])
    moved = scenarios.partner_terms(facts, terms, "share", 0.5)
    assert rows(moved, "partner", "claims", "net_retained_cents", "scenario_retained_cents", "gain_cents") == [
        ("direct", 1, 700, 700, 0),
        ("flat", 1, 700, 700, 0),
        ("share", 2, 300, 750, 450),
    ]
    # 0.05% of 20,000 dollars is 10 dollars: the flat partner still takes one of them, the other 80%.
    repriced = scenarios.reprice_band(facts, terms, 1_000_000, 0.0005)
    assert rows(repriced, "partner", "gain_cents") == [("direct", 0), ("flat", 200), ("share", 200 + 0 - 160)]


def test_average_cost_takes_very_small_and_very_large_rates(frame):
    facts = "ndc string, partner string, pharmacy_npi string, quantity double, unit_cost_usd double, is_reverted boolean, has_cost_match boolean, " + ", ".join(
        f"{c} bigint"
        for c in (
            "net_claim_count net_price_cents net_retained_cents net_partner_fee_cents est_acquisition_cost_cents "
            "pharmacy_margin_cents retained_fee_cents generic_substitution_savings_cents"
        ).split()
    )
    rates = [4e-9, 1e21, 2.0, None]
    claims = frame(facts, [("n", "p", "s", 1.0, r, False, r is not None, *[1] * 8) for r in rates])
    drugs = frame("ndc string, ndc_description string, drug_class string, is_otc boolean, is_in_nadac boolean", [("n", "d", "brand", False, True)])
    row = marts.drug_economics(drugs, claims, frame("ndc string", [("n",)])).first()
    assert row.avg_unit_cost_usd == sum(r for r in rates if r is not None) / 3
    tiny = marts.drug_economics(drugs, claims.where("unit_cost_usd < 1e-8"), frame("ndc string", [("n",)])).first()
    assert tiny.avg_unit_cost_usd == 4e-9
