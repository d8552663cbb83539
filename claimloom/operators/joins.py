"""Many-to-one joins, one plan per role of the unique side.

``attach(many, one, on)`` joins a table whose rows are unique per key to one whose rows are not. The caller says what
the unique side is, so the plan does not depend on how large a day's files are:

* a reference table (``reference=True``): broadcast, ``many`` is not shuffled. The query fails, with a message, if the
  table really has more than REFERENCE_ROWS rows;
* anything else: a sort-merge join on the key, or where its parts are of bounded size (``hashed=True``) a hash table of
  the unique side per part, which leaves the wide rows unsorted. Adaptive execution splits a frequent key's partition. Rows without a
  key, which a left join keeps, would all meet in one task: where many rows may lack one (``keyless=True``) they are
  taken out before the join, not shuffled at all, and put back behind it, at the price of planning ``many`` twice.

``maybe_among`` leaves out rows whose key cannot be among those of another table before the rows are shuffled. Its
broadcast has at most FILTER_WORDS rows whatever the tables' sizes.

``spread`` shuffles rows by a key into as many parts as the batch needs, and joins and aggregates on that key find them
in place. Without it their number is the session's, so that parts grow with the batch until sorting them spills.

Declaring a join starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REFERENCE_ROWS = 1_000_000
"""Most rows of a table that is declared a reference table."""

FILTER_WORDS = 1 << 16
"""Most rows of a key filter, of 64 bits each: a million keys let one other key in four or five pass."""


UNSORTED_PARTS = 200
"""Most parts that a map task writes without sorting its rows by part, as Spark is set."""

PART_ROWS = 250_000
"""Rows of a part while there are at most UNSORTED_PARTS of them, so that a sort of wide rows stays in memory."""

MOST_ROWS = 1_200_000
"""Rows of a part beyond."""


def parts_for(rows: int, least: int) -> int:
    """Into how many parts a batch is shuffled whose largest table has ``rows`` rows; ``least``: the session's number."""
    return max(least, min(UNSORTED_PARTS, rows // PART_ROWS), rows // MOST_ROWS)


def spread(rows: DataFrame, on: str | Sequence[str], parts: int | None) -> DataFrame:
    """The rows shuffled by ``on`` into ``parts``; without a number as they are, to be shuffled as the session is set."""
    return rows if parts is None else rows.repartition(parts, *([on] if isinstance(on, str) else on))


def guarded(reference: DataFrame) -> DataFrame:
    """The reference table, to be broadcast; fails when it is read if it has too many rows."""
    n = reference.agg(F.count("*")).scalar()
    too_many = F.raise_error(F.lit(f"a reference table has more than {REFERENCE_ROWS} rows"))
    return F.broadcast(reference.where(F.when(n <= REFERENCE_ROWS, F.lit(True)).otherwise(too_many.cast("boolean"))))


def attach(
    many: DataFrame,
    one: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    reference: bool = False,
    keyless: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Join ``one`` (unique per ``on``) to ``many``. ``how``: left, inner, left_semi or left_anti.

    ``keyless``: many rows of ``many`` may have a NULL in ``on``; they match nothing. ``hashed``: both tables are spread by
    ``on`` into parts of bounded size, so that those of ``one`` fit in memory.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if reference:
        return many.join(guarded(one), keys, how)
    if not keyless or how not in ("left", "left_anti"):
        return many.join(one.hint("shuffle_hash" if hashed else "merge"), keys, how)
    no_key = reduce(or_, (F.col(k).isNull() for k in keys))
    joined = many.where(~no_key).join(one.hint("merge"), keys, how)
    alone = many.where(no_key)
    if how == "left":
        alone = alone.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in one.schema if f.name not in keys))
    return joined.unionByName(alone)


def maybe_among(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose key may be one of ``keys``: all of those, and of other keys about one in
    (64 * FILTER_WORDS / number of keys). Rows without a key are left out.

    Neither the place of a key nor that of its word is ever null: the join then asks nothing more of ``keys`` nor of
    ``rows``, and where these are read elsewhere too, one shuffle serves both.
    """

    def place(c: str):
        return F.coalesce(F.pmod(F.xxhash64(c), F.lit(64 * FILTER_WORDS)), F.lit(0).cast("bigint"))

    bit = F.expr("shiftleft(1L, cast(__place % 64 as int))")
    word = F.coalesce((F.col("__place") / 64).cast("int"), F.lit(0))
    placed = keys.where(F.col(on).isNotNull()).select(place(on).alias("__place"))
    words = placed.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    asked = rows.where(F.col(on).isNotNull()).withColumn("__place", place(on))
    asked = asked.withColumn("__word", word)
    found = asked.join(F.broadcast(words), "__word")
    return found.where(F.col("__bits").bitwiseAND(bit) != 0).select(*rows.columns)
