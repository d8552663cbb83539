"""A grid of rates gives what the scenario of each rate gives."""

import random

import pytest
from conftest import rows

from claimloom.plans import grid, scenarios

RATES = [n / 40 for n in range(1, 21)]
TERMS = [("P", "flat", 120, None), ("Q", "percentage", None, 0.3), ("R", "unknown", None, None), ("S", "percentage", None, 1.4)]


@pytest.fixture
def claims(frame):
    rng = random.Random(6)
    made = []
    for _ in range(400):
        partner, price, fee = rng.choice("PQRST"), rng.randrange(1, 3000), rng.randrange(0, 600)
        made.append((partner, price, fee, fee - min(fee, rng.randrange(200)), rng.random() < 0.2))
    made += [("P", 1000, 0, 0, False), ("U", 5, 5, 5, True)]
    return frame("partner string, price_cents long, pbm_fee_cents long, retained_fee_cents long, is_reverted boolean", made)


@pytest.fixture
def terms(frame):
    return frame("partner string, fee_model string, flat_fee_cents long, fee_rate double", TERMS)


COLUMNS = ["partner", "claims", "net_retained_cents", "scenario_retained_cents", "gain_cents"]


def test_reprice_band(claims, terms):
    got = grid.reprice_band_grid(claims, terms, 1000, RATES).cache()
    assert got.count() == len(RATES) * 5
    for rate in RATES[::4]:
        expected = scenarios.reprice_band(claims, terms, 1000, rate)
        assert rows(got.where(got.rate == rate), *COLUMNS) == rows(expected, *COLUMNS)


@pytest.mark.parametrize("partner", ["P", "Q"])
def test_partner_terms(claims, terms, partner):
    got = grid.partner_terms_grid(claims, terms, partner, RATES).cache()
    assert got.count() == len(RATES)
    for rate in RATES[::5]:
        expected = scenarios.partner_terms(claims, terms, partner, rate).where(f"partner = '{partner}'")
        assert rows(got.where(got.rate == rate), *COLUMNS) == rows(expected, *COLUMNS)


def test_one_scan_for_all_rates_and_no_claims(claims, terms):
    got = grid.reprice_band_grid(claims, terms, 1000, [n / 1000 for n in range(1000)])
    assert got.select("rate").distinct().count() == 1000
    assert grid.reprice_band_grid(claims.where("false"), terms, 1000, RATES).count() == 0
