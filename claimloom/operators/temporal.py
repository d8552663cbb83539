"""First / latest per key, as-of joins and calendars."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.joins import attach, maybe_among, spread


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None
) -> DataFrame:
    """The first row of each key in the given order, which should be total.

    Catalyst keeps one row per key and task before the shuffle (WindowGroupLimit), so a hot key stays small. With ``parts``
    the rows are shuffled first and sorted in parts of bounded size: for tables with few rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return spread(df, keys, parts).withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")


def earliest_with_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    count_as: str,
    parts: int | None = None,
) -> DataFrame:
    """The earliest event of each key plus the number of events, as one map-side combined aggregate; with ``parts`` the
    rows are shuffled first, so that no task sorts its whole input."""
    fields = [*order, *(c for c in payload if c not in order)]
    first = spread(df, keys, parts).groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__first"), F.count("*").alias(count_as))
    return first.select(*keys, *(F.col(f"__first.{c}").alias(c) for c in fields), count_as)


def asof_left_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    since: str,
    payload: Sequence[str],
    *,
    bucket: Callable[[str], Column] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """For each fact the history row of its key with the greatest ``since <= at``, inclusive; NULLs when none.

    ``history`` is unique per (key, since). Columns added: ``since`` and ``payload``.

    Each distinct (key, at) pair is resolved once and the answers are attached to the facts. Pairs are made distinct
    before the shuffle, so a hot key shrinks to its distinct instants, and versions of keys that no fact has are left
    out before theirs: a history is often of many more keys than are seen. Pairs and versions of
    a key are read in time order and the last version is carried forward. With ``bucket`` a key's time line is cut
    into buckets: within a bucket as before, and where a bucket has no earlier version, the last one of the buckets
    before it, found over one row per key and bucket.
    """
    history = history.select(key, since, *payload)
    bucketed = bucket or (lambda _: F.lit(0))
    mark = F.struct(F.col(since).alias("s"), *(F.col(c).alias(f"p{i}") for i, c in enumerate(payload)))
    probes = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, F.col(at).alias("__t")).distinct()
    observed = maybe_among(history, probes, key)
    marks = observed.where(F.col(since).isNotNull()).select(
        key, F.col(since).alias("__t"), mark.alias("__mark")
    )
    mark_type = marks.schema["__mark"].dataType
    events = [marks.withColumn("__probe", F.lit(0)), probes.withColumns({"__mark": F.lit(None).cast(mark_type), "__probe": F.lit(1)})]
    # Each by itself: a history that is in place by the key stays there.
    by = [key] if bucket is None else [key, "__bucket"]
    line = DataFrame.unionByName(*(spread(e.withColumn("__bucket", bucketed("__t")), by, parts) for e in events))
    so_far = Window.partitionBy(key, "__bucket").orderBy("__t", "__probe").rowsBetween(Window.unboundedPreceding, 0)
    answers = line.withColumn("__mark", F.last("__mark", ignorenulls=True).over(so_far)).where("__probe = 1")
    if bucket is not None:
        # The latest version inside each bucket, then the latest of all buckets before it.
        marked_at = F.when(F.col("__probe") == 0, F.col("__t"))
        closing = line.groupBy(key, "__bucket").agg(F.max_by("__mark", marked_at).alias("__closing"))
        before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        opening = closing.select(key, "__bucket", F.last("__closing", ignorenulls=True).over(before).alias("__open"))
        answers = attach(answers, opening, [key, "__bucket"], "left")
        answers = answers.withColumn("__mark", F.coalesce("__mark", "__open"))
    answers = answers.where(F.col("__mark").isNotNull()).select(
        key,
        F.col("__t").alias(at),
        F.col("__mark.s").alias(since),
        *(F.col(f"__mark.p{i}").alias(c) for i, c in enumerate(payload)),
    )
    return attach(spread(facts, [key, at], parts), answers, [key, at], "left", hashed=parts is not None)


def interval_left_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    since: str,
    payload: Sequence[str],
    *,
    days: int = 90,
    parts: int | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """As :func:`asof_left_join` over dates, as a bounded interval join for very long histories per key.

    A version holds from its date to the day before the next one. It is dealt to the bins of ``days`` days that it
    reaches into, a fact to the bin of its day, and a fact meets the versions of its key and bin only; the one that
    holds on its day is the answer. So a hot key is spread over its bins. Narrow bins spread more, wide ones repeat
    long versions less. A version after the last fact is dealt to no bin, one that still holds up to the last fact's.

    ``seen``: a table that has the (key, at) of all facts, and maybe others, and is cheaper to read. Only which versions
    are left out is told by it, and leaving out fewer changes no answer.
    """

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")

    no_answer = F.col(key).isNull() | F.col(at).isNull()
    asked = facts.where(~no_answer)
    next_since = F.lead(since).over(Window.partitionBy(key).orderBy(since))
    # The filter and the last day read the same columns of the facts, so that one shuffle behind them serves both.
    probes = asked.select(key, at).distinct() if seen is None else seen.where(~no_answer).select(key, at)
    held = maybe_among(history.select(key, since, *payload), probes, key).where(F.col(since).isNotNull())
    last = probes.agg(F.max(F.struct(at, key)).alias("__last")).select(f"__last.{at}").scalar()
    versions = spread(held, key, parts).withColumn("__until", next_since).where(F.col(since) <= last)
    reach = F.sequence(bin_of(F.col(since)), bin_of(F.least(F.date_sub("__until", 1), last)))
    dealt = versions.withColumn("__bin", F.explode(reach)).select(
        F.col(key).alias("__key"), "__bin", "__until", F.col(since).alias("__since"), *(F.col(c).alias(f"__p_{c}") for c in payload)
    )
    holds = (F.col(at) >= F.col("__since")) & (F.col("__until").isNull() | (F.col(at) < F.col("__until")))
    binned = spread(asked.withColumn("__at_bin", bin_of(F.col(at))), [key, "__at_bin"], parts)
    same = (binned[key] == dealt["__key"]) & (F.col("__at_bin") == F.col("__bin"))
    answers = [F.col("__since").alias(since), *(F.col(f"__p_{c}").alias(c) for c in payload)]
    found = binned.join(dealt.hint("merge"), same & holds, "left").select(*facts.columns, *answers)
    nothing = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in (since, *payload)]
    return found.unionByName(facts.where(no_answer).select("*", *nothing))


def calendar(bounds: DataFrame, first: str, last: str, out: str = "date_day") -> DataFrame:
    """Every day from a one-row bounds frame; no row when the bounds are NULL."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(out))
