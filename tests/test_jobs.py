"""Land and build a small warehouse from files, with checks between the stages."""

import json

import pytest
from conftest import rows

from claimloom import jobs
from claimloom.plans import checks
from claimloom.sources import landing, tables

STAMP = "2026-05-{:02d}T10:00:00"


def claim(i, **changes):
    event = {"id": f"c{i}", "npi": "1", "ndc": "00001", "price": 100.0, "quantity": 30, "pbm_fee": 5.0, "timestamp": STAMP.format(1 + i % 28)}
    return event | changes


def lookup(i, **changes):
    event = {"id": f"l{i}", "claim_id": f"c{i}", "ndc": "00001", "partner": "Half", "channel": "Website", "timestamp": STAMP.format(1)}
    return event | changes


@pytest.fixture
def paths(tmp_path):
    claims = [claim(i) for i in range(30)]
    claims += [claim(30, price="one hundred"), claim(31, npi="9"), claim(32), claim(32, price=7)]
    sources = {
        "claims": claims,
        "reverts": [{"id": f"r{i}", "claim_id": f"c{i}", "timestamp": STAMP.format(28)} for i in (0, 1, 31)],
        "lookups": [lookup(i, partner=None if i == 3 else "Half") for i in range(20)] + [lookup(50), lookup(51, claim_id=None)],
    }
    for source, events in sources.items():
        (tmp_path / source).mkdir()
        half = len(events) // 2
        (tmp_path / source / "1.json").write_text(json.dumps(events[:half]))
        (tmp_path / source / "2.json").write_text(json.dumps(events[half:]))
    (tmp_path / "pharmacies.csv").write_text("chain,npi\nSaint,1\n")
    (tmp_path / "partners.csv").write_text("partner,fee_cents,fee_percentage\nHalf,,50.0\n")
    header = ",".join(landing.PRICE_HEADERS)
    (tmp_path / "prices.csv").write_text(f"{header}\n00001,Item,1.5,01/01/2026,01/08/2026,EA,B,N,0.5\n")
    where = {s: str(tmp_path / s) for s in sources}
    return where | {n: str(tmp_path / f) for n, f in [("pharmacies", "pharmacies.csv"), ("partners", "partners.csv"), ("price_history", "prices.csv")]}


def test_land_and_build(spark, paths, tmp_path):
    root = str(tmp_path / "root")
    assert jobs.land(spark, paths, root) == {
        "claims": 34, "reverts": 3, "lookups": 22, "pharmacies": 1, "partners": 1, "price_history": 1,
    }
    wh = jobs.build(spark, root, allow=["rows.rejection_rate"])
    totals = spark.sql(
        "SELECT count(*) AS n, sum(net_claim_count) AS net, sum(net_price_cents) AS gmv, sum(net_retained_cents) AS kept, "
        "sum(pharmacy_margin_cents) AS margin FROM marts.fct_claim WHERE event_month = date'2026-05-01'"
    ).first()
    assert totals.n == 30 and totals.net == 28 and totals.gmv == 28 * 10_000
    # Lookups 0 to 19 convert; 3 has no partner; claims 0 and 1 are reversed.
    assert totals.kept == 28 * 500 - 17 * 250
    assert totals.margin == 30 * (10_000 - 4_500 - 500)
    assert rows(spark.table("marts.dq_rejects"), "source_table", "reject_reason", "defect_class") == [
        ("claims", "duplicate_claim_id", "ambiguous"),
        ("claims", "duplicate_claim_id", "ambiguous"),
        ("claims", "unknown_npi", "out_of_scope"),
        ("claims", "unparseable_number", "malformed"),
        ("reverts", "orphan_claim_id", "out_of_scope"),
    ]
    funnel = spark.table("marts.mart_funnel_daily").agg({c: "sum" for c in ("lookups", "claims", "reverts_on_day")}).first()
    assert sorted(funnel) == [2, 22, 30]
    assert spark.table("lookups_resolved").where("has_unresolvable_claim_id").count() == 1
    assert wh.mart_partner_performance.count() == 3

    other = str(tmp_path / "other")
    jobs.land(spark, paths, other)
    again = jobs.build(spark, other, select=["mart_partner_performance"], reuse=root)
    assert rows(again.mart_partner_performance) == rows(wh.mart_partner_performance)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.open_table(spark, other, "marts", "fct_claim")
    assert again.fct_claim.columns == wh.fct_claim.columns
    assert spark.table("marts.fct_claim").columns == [*wh.fct_claim.columns, "event_month"]


def test_a_failing_check_stops_the_build(spark, paths, tmp_path):
    root = str(tmp_path / "root")
    twice = tmp_path / "twice.csv"
    twice.write_text("partner,fee_cents,fee_percentage\nHalf,,50.0\nHalf,10,\n")
    jobs.land(spark, paths | {"partners": str(twice)}, root)
    with pytest.raises(jobs.CheckFailed) as stopped:
        jobs.build(spark, root)
    assert stopped.value.violations == {"stg_partners.partner.unique": 1}
    assert not (tmp_path / "root" / "marts").exists()
    # The bad table was written, but its name still leads to what was there before.
    assert not spark.catalog.tableExists("staging.stg_partners") or root not in (
        spark.sql("DESCRIBE EXTENDED staging.stg_partners").where("col_name = 'Location'").first().data_type
    )


def test_a_renamed_field_trips_the_rejection_rate(spark, paths, tmp_path):
    changed = [{("amount" if k == "price" else k): v for k, v in claim(i).items()} for i in range(30)]
    (tmp_path / "claims" / "1.json").write_text(json.dumps(changed))
    (tmp_path / "claims" / "2.json").write_text("[]")
    root = str(tmp_path / "root")
    jobs.land(spark, paths, root)
    with pytest.raises(jobs.CheckFailed) as stopped:
        jobs.build(spark, root)
    assert "rows.rejection_rate" in stopped.value.violations


def test_arguments():
    with pytest.raises(SystemExit):
        jobs.parse_args(["--root", "r"])
    args = jobs.parse_args(["--root", "r", "--skip-land", "--select", "marts", "fct_claim"])
    assert args.select == ["marts", "fct_claim"] and not args.skip_build


def test_a_table_is_selected_with_what_depends_on_it():
    assert jobs.selected(["dim_drug"]) == {"dim_drug"}
    assert jobs.selected(["dim_drug+"]) == {"dim_drug", "mart_drug_economics"}
    assert jobs.selected(["stg_partners+"]) == {
        "stg_partners", "dim_partner", "fct_claim", "fct_lookup", "mart_drug_economics", "mart_partner_performance",
        "mart_funnel_daily",
    }
    assert jobs.selected(["marts"]) > {"fct_claim", "dq_rejects"} and "stg_claims" not in jobs.selected(None)
    with pytest.raises(ValueError):
        jobs.selected(["fct_clam"])


def test_everything_declared_is_checked(spark, paths, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    jobs.land(spark, paths, root)
    ran = set()

    def note(results):
        ran.update(r.check_name.split(".")[0] for r in checks.union(results).collect())
        return {}

    monkeypatch.setattr(jobs, "violations", note)
    jobs.build(spark, root)
    assert ran >= {t for layer in checks.ALL for t in layer}
