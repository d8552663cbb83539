"""SQL expression -> Column helpers. Built-in expressions only, so they stay inside codegen.

They take text rather than Columns so that each is one call from Python, however many functions it combines.
"""

from claimloom.functions.money import safe_ratio, to_cents
from claimloom.functions.parsing import parse_bigint, parse_double, parse_timestamp, parse_us_date
from claimloom.functions.text import clean_text, lower_text, or_default, upper_text
from claimloom.functions.timing import hours_crossed, minutes_crossed, with_calendar

__all__ = [
    "clean_text",
    "hours_crossed",
    "lower_text",
    "minutes_crossed",
    "or_default",
    "parse_bigint",
    "parse_double",
    "parse_timestamp",
    "parse_us_date",
    "safe_ratio",
    "to_cents",
    "upper_text",
    "with_calendar",
]
