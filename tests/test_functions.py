"""Parsing, money and time, value by value."""

import datetime as dt
import math

import pytest
from claimloom import functions as fn

TS = "timestamp_ntz"


def evaluate(frame, schema, values, expression):
    df = frame(schema, [v if isinstance(v, tuple) else (v,) for v in values])
    return [r.out for r in df.select(expression.alias("out")).collect()]


def test_text(frame):
    values = [" a ", "", "   ", None, "\t"]
    assert evaluate(frame, "x string", values, fn.clean_text("x")) == ["a", None, None, None, "\t"]
    assert evaluate(frame, "x string", [" APP ", " "], fn.lower_text("x")) == ["app", None]
    assert evaluate(frame, "x string", [" ea"], fn.upper_text("x")) == ["EA"]


NUMBERS = {
    "4.35": 4.35,
    " 12 ": 12.0,
    "1e2": 100.0,
    ".5": 0.5,
    "5.": 5.0,
    "-3": -3.0,
    "+4": 4.0,
    "one hundred": None,
    "1.0d": None,
    "1f": None,
    "1_000": None,
    "NaN": None,
    "Infinity": None,
    "1e999": None,
    "0x10": None,
    "": None,
    None: None,
}


def test_double(frame):
    assert evaluate(frame, "x string", list(NUMBERS), fn.parse_double("x")) == list(NUMBERS.values())


STAMPS = {
    "2026-05-01T10:20:30": dt.datetime(2026, 5, 1, 10, 20, 30),
    "2026-05-01 10:20": dt.datetime(2026, 5, 1, 10, 20),
    "2026-5-1": dt.datetime(2026, 5, 1),
    "2026-05-01T10:20:30Z": dt.datetime(2026, 5, 1, 10, 20, 30),
    "2026-05-01T10:20:30+05:00": dt.datetime(2026, 5, 1, 10, 20, 30),
    "2026-13-45T99:99:99": None,
    "not-a-date": None,
    "2026": None,
    "2026-05": None,
    "2026-05-01T10": None,
    "now": None,
    "epoch": None,
    " 2026-05-01": None,
    "": None,
}


def test_timestamp(frame):
    assert evaluate(frame, "x string", list(STAMPS), fn.parse_timestamp("x")) == list(STAMPS.values())


def test_bigint_rounds_decimals(frame):
    values = {"1.7": 2, "100.0": 100, "2.5": 3, "0": 0, "": None, "x": None, "1e30": None}
    assert evaluate(frame, "x string", list(values), fn.parse_bigint("x")) == list(values.values())


def test_us_date(frame):
    values = {"03/04/2026": dt.date(2026, 3, 4), "3/4/2026": dt.date(2026, 3, 4), "2026-03-04": None, "13/40/2026": None}
    values |= {"02/29/2024": dt.date(2024, 2, 29), "02/29/2026": None, "3/4/26": None, "": None, None: None}
    assert evaluate(frame, "x string", list(values), fn.parse_us_date("x")) == list(values.values())


@pytest.mark.parametrize(
    "amount, cents",
    [(4.35, 435), (8.41, 841), (2.5, 250), (-2.5, -250), (1.005, 100), (0.285, 28), (0.13478 * 45, 607), (1e30, None)],
)
def test_cents(frame, amount, cents):
    got = evaluate(frame, "x double", [amount], fn.to_cents("x"))[0]
    # Half cents follow the binary value of amount * 100.
    assert got == (None if cents is None else math.floor(abs(amount * 100) + 0.5) * (1 if amount > 0 else -1))
    assert cents is None or abs(got - cents) <= 1


def test_ratio(frame):
    values = [(1, 7), (1, 0), (1, None), (None, 2), (0, 5)]
    assert evaluate(frame, "a bigint, b bigint", values, fn.safe_ratio("a", "b")) == [
        1 / 7,
        None,
        None,
        None,
        0.0,
    ]


def test_elapsed_time_counts_boundaries(frame):
    day = lambda h, m: dt.datetime(2026, 3, 1, h, m)
    pairs = [(day(10, 59), day(11, 1)), (day(11, 1), day(10, 59)), (day(10, 0), day(10, 59)), (day(1, 0), None)]
    hours = fn.hours_crossed("a", "b")
    minutes = fn.minutes_crossed("a", "b")
    assert evaluate(frame, f"a {TS}, b {TS}", pairs, hours) == [1, -1, 0, None]
    assert evaluate(frame, f"a {TS}, b {TS}", pairs, minutes) == [2, -2, 59, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_calendar_does_not_depend_on_the_session_zone(spark, frame, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = frame("d date", [(dt.date(2026, 3, 1),), (dt.date(2026, 3, 8),), (dt.date(2026, 3, 9),)])
        got = [tuple(r) for r in fn.with_calendar(days, "d").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        (dt.date(2026, 3, 1), 2026, 3, dt.date(2026, 3, 1), dt.date(2026, 2, 23), 0, "Sunday", True),
        (dt.date(2026, 3, 8), 2026, 3, dt.date(2026, 3, 1), dt.date(2026, 3, 2), 0, "Sunday", True),
        (dt.date(2026, 3, 9), 2026, 3, dt.date(2026, 3, 1), dt.date(2026, 3, 9), 1, "Monday", False),
    ]
