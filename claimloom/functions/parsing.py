"""Fault-tolerant casts: a value that does not parse is NULL, never an error.

A bare ``try_cast`` accepts more than the accepted input grammar (``1.0d``, ``NaN``, ``now``, ``2026``), so each
cast is guarded by a pattern. Arguments are column names or SQL expressions.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TIMESTAMP = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
US_DATE = "M/d/yyyy"

LARGEST = f"{sys.float_info.max}D"


def _double(x: str) -> str:
    number = f"try_cast(trim({x}) AS double)"
    return f"CASE WHEN trim({x}) RLIKE r'{NUMBER}' AND abs({number}) <= {LARGEST} THEN {number} END"


def parse_double(x: str) -> Column:
    """Text to a finite double."""
    return F.expr(_double(x))


def parse_bigint(x: str) -> Column:
    """Text to bigint; a decimal is rounded half away from zero (``1.7`` is 2)."""
    return F.expr(f"try_cast(round({_double(x)}) AS bigint)")


def parse_timestamp(x: str) -> Column:
    """Text to a timestamp without zone; a zone suffix is read past, not applied."""
    return F.expr(f"CASE WHEN {x} RLIKE r'{TIMESTAMP}' THEN try_cast({x} AS timestamp_ntz) END")


def parse_us_date(x: str) -> Column:
    """``3/4/2026`` or ``03/04/2026`` to a date."""
    return F.expr(f"try_to_date({x}, '{US_DATE}')")
