"""Late rows change the months they touch and nothing else; the result is that of a full build."""

import json
import shutil
from datetime import date
from pathlib import Path

import pytest
from conftest import rows

from claimloom import jobs
from claimloom.refresh import refresh
from claimloom.sources import landing, tables

COMPARED = ["fct_claim", "fct_lookup", "dq_rejects", "mart_partner_performance", "mart_drug_economics", "mart_funnel_daily", "dim_date", "dim_drug"]


def claim(i, month, **changes):
    event = {"id": f"c{i}", "npi": "1", "ndc": f"0000{i % 3}", "price": 100.0, "quantity": 3, "pbm_fee": 5.0}
    return event | {"timestamp": f"2026-{month:02d}-{1 + i % 27:02d}T10:00:00"} | changes


def lookup(i, claim_id, month=1):
    stamp = f"2026-{month:02d}-02T09:00:00"
    return {"id": f"l{i}", "claim_id": claim_id, "ndc": "00001", "partner": "Half", "channel": "website", "timestamp": stamp}


def revert(i, claim_id, stamp="2026-06-20T10:00:00"):
    return {"id": f"r{i}", "claim_id": claim_id, "timestamp": stamp}


EVENTS = {
    "claims": [claim(i, 1 + i // 10) for i in range(40)] + [claim(90, 9)],
    "reverts": [revert(0, "c3"), revert(1, "c25")],
    "lookups": [lookup(i, f"c{i}", 1 + i % 4) for i in range(30)] + [lookup(40, None, 2), lookup(41, "late", 3)],
}
LATE = {
    "a late reversal": ({"reverts": [revert(7, "c12")]}, [2], [1]),
    "a reversal whose id was there before": ({"reverts": [revert(0, "c35")]}, [1, 4], [4]),
    "a claim that makes its month empty": ({"claims": [claim(90, 3)]}, [9], []),
    "all of them": (
        {
            "claims": [claim(99, 2), claim(77, 5) | {"id": "late"}],
            "reverts": [revert(11, "c99"), revert(12, "c12"), revert(8, "none"), revert(9, None)],
            "lookups": [lookup(60, "c99", 6), lookup(50, "c39", 7), lookup(51, None, 8)],
        },
        [2, 4, 5],
        [1, 3, 6, 7, 8],
    ),
}


def write(folder: Path, events) -> dict:
    paths = {}
    for source in ("claims", "reverts", "lookups"):
        (folder / source).mkdir(parents=True)
        (folder / source / "a.json").write_text(json.dumps([e | {"id": str(e["id"])} for e in events.get(source, [])]))
        paths[source] = str(folder / source)
    (folder / "sites.csv").write_text("npi,chain\n1,x\n")
    (folder / "terms.csv").write_text("partner,fee_cents,fee_percentage\nHalf,,50\n")
    prices = [f"0000{n},Item,1.5,0{m}/01/2026,0{m}/08/2026,EA,B,N,0.5" for n in range(3) for m in (1, 3)]
    (folder / "prices.csv").write_text(",".join(landing.PRICE_HEADERS) + "\n" + "\n".join(prices) + "\n")
    others = {"pharmacies": "sites.csv", "partners": "terms.csv", "price_history": "prices.csv"}
    return paths | {n: str(folder / f) for n, f in others.items()}


def files(root, fact):
    """The data files of a fact, by month."""
    found = {}
    for f in Path(root, "marts", fact).glob("event_month=*/*.parquet"):
        found.setdefault(date.fromisoformat(f.parent.name.split("=")[1]), set()).add(f.name)
    return found


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The root of a warehouse, to be copied."""
    folder = tmp_path_factory.mktemp("built")
    jobs.land(spark, write(folder / "in", EVENTS), str(folder / "root"))
    jobs.build(spark, str(folder / "root"), run_checks=False)
    return folder / "root"


@pytest.mark.parametrize("case", LATE)
def test_only_touched_months_change_and_equal_a_full_build(spark, tmp_path, built, case):
    events, claim_months, lookup_months = LATE[case]
    root, full = str(tmp_path / "root"), str(tmp_path / "full")
    shutil.copytree(built, root)
    before = {fact: files(root, fact) for fact in ("fct_claim", "fct_lookup")}
    paths = write(tmp_path / "late", events)
    late = {s: landing.read_events(spark, s, paths[s]) for s in events}

    months = refresh(spark, root, late, allow=["rows.rejection_rate"])
    assert months == {
        "fct_claim": [date(2026, m, 1) for m in claim_months],
        "fct_lookup": [date(2026, m, 1) for m in lookup_months],
    }
    for fact, had in before.items():
        has = files(root, fact)
        for month in had.keys() | has.keys():
            assert (had.get(month) == has.get(month)) == (month not in months[fact]), (fact, month)

    together = {s: EVENTS[s] + events.get(s, []) for s in EVENTS}
    jobs.land(spark, write(tmp_path / "all", together), full)
    jobs.build(spark, full, run_checks=False)
    for name in COMPARED:
        one, other = (tables.open_table(spark, r, "marts", name).drop("_source_file") for r in (root, full))
        assert rows(one) == rows(other), name
    for source in EVENTS:
        assert tables.open_table(spark, root, "raw", source).count() == len(together[source])


def test_new_rows_are_checked_before_they_are_written(spark, tmp_path, built, monkeypatch):
    root = str(tmp_path / "root")
    shutil.copytree(built, root)
    before = files(root, "fct_claim")
    paths = write(tmp_path / "late", {"reverts": [revert(7, "c12")]})
    monkeypatch.setattr("claimloom.plans.checks.net_zero_predicates", lambda: {"never": "is_reverted"})
    with pytest.raises(jobs.CheckFailed):
        refresh(spark, root, {"reverts": landing.read_events(spark, "reverts", paths["reverts"])})
    assert files(root, "fct_claim") == before
    assert tables.open_table(spark, root, "raw", "reverts").count() == 2
