"""Sketches merged over days stay near the exact values, whatever the grouping."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows

from claimloom.operators import sketches
from claimloom.plans import marts, reports

SCHEMA = "filled_date date, partner string, pharmacy_npi string, ndc string, hours_to_revert long"


@pytest.fixture
def facts(frame):
    rng, made = random.Random(4), []
    for i in range(30_000):
        day = date(2026, 1, 1) + timedelta(days=rng.randrange(60))
        hours = int(rng.expovariate(0.01)) if rng.random() < 0.3 else None
        made.append((day, rng.choice("PPPQ"), f"n{rng.randrange(9000)}", f"d{i % 3}", hours))
    made.append((date(2026, 5, 4), "none reversed", None, "d1", None))
    return frame(SCHEMA, made)


def test_merged_sketches_are_near_the_exact_values(facts):
    daily = marts.sketches_daily(facts).cache()
    checked = reports.weekly_distinct_checked(daily, facts).collect()
    assert len(checked) == 2 * 9 + 1 and all(r.pharmacies_near and r.drugs_near for r in checked)
    assert {r.exact_drugs for r in checked if r.partner in "PQ"} == {3}
    lonely = [r for r in checked if r.partner == "none reversed"][0]
    assert (lonely.claims, lonely.exact_pharmacies) == (1, 0)
    medians = {r.partner: (r.reversals, r.median_hours) for r in reports.median_hours(daily).collect()}
    assert medians["none reversed"] == (0, None) and 55 < medians["P"][1] < 85
    assert {r.partner: r.median_near for r in reports.median_hours_checked(daily, facts).collect()} == {"P": True, "Q": True}


def test_distinct_counts_do_not_depend_on_the_way_they_are_merged(facts):
    daily = marts.sketches_daily(facts)
    weekly = sketches.merged(daily.withColumn("w", daily.date_day.substr(1, 7)), ["w", "partner"], ["pharmacies_sketch"])
    names = {"pharmacies_sketch": "n"}
    one, two = (sketches.distinct_estimates(sketches.merged(d, ["partner"], ["pharmacies_sketch"]), names) for d in (daily, weekly))
    assert rows(one) == rows(two)


def test_wrong_values_are_told(frame):
    df = frame("estimate long, exact long, below long, upto long, n long", [(1000, 1200, 600, 601, 1000), (11, 10, 490, 500, 1000)])
    told = df.select(sketches.near_distinct("estimate", "exact"), sketches.near_rank("below", "upto", "n", 0.5))
    assert rows(told) == [(False, False), (True, True)]


def test_no_claims(facts):
    daily = marts.sketches_daily(facts.where("false"))
    assert reports.weekly_distinct(daily).count() == 0 and reports.median_hours(daily).count() == 0
