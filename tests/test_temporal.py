"""As-of joins against brute force, first and latest per key, calendars."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom.functions import minutes_crossed
from claimloom.operators import temporal
from claimloom.operators.joins import maybe_among
from claimloom.operators.temporal import asof_left_join, interval_left_join

EPOCH = dt.datetime(2026, 1, 1)


def moments(rng, n):
    """Whole minutes in a short period, so that equal instants occur."""
    return [EPOCH + dt.timedelta(minutes=rng.randrange(600)) for _ in range(n)]


def brute_force(facts, history):
    out = []
    for i, k, t in facts:
        best = max((h for h in history if h[0] == k and t is not None and h[1] <= t), key=lambda h: h[1], default=None)
        out.append((i, k, t, best and best[1], best and best[2]))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    # One key has a third of the facts.
    keys = ["hot" if rng.random() < 0.34 else rng.choice("abcd") for _ in range(300)]
    facts = [(i, k, t) for i, (k, t) in enumerate(zip(keys, moments(rng, 300)))]
    facts += [(1000, None, EPOCH), (1001, "a", None), (1002, "absent", EPOCH)]
    versions = {(rng.choice(["hot", "a", "b", "c"]), t) for t in moments(rng, 60)}
    history = [(k, t, None if i % 7 == 0 else i) for i, (k, t) in enumerate(sorted(versions))]
    return facts, history


BUCKETS = {
    "whole": {},
    "by day": dict(bucket=F.to_date),
    "by hour": dict(bucket=lambda t: F.hour(t)),
    "by minute": dict(bucket=lambda t: minutes_crossed("DATE'2026-01-01'", t)),
}


@pytest.mark.parametrize("form", BUCKETS)
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_forms_equal_brute_force(frame, form, seed):
    facts, history = case(seed)
    f = frame("i int, k string, t timestamp_ntz", facts)
    h = frame("k string, since timestamp_ntz, v int", history)
    got = temporal.asof_left_join(f, h, "k", "t", "since", ["v"], **BUCKETS[form])
    assert rows(got, "i", "k", "t", "since", "v") == brute_force(facts, history)


def test_one_per_key_limits_before_the_shuffle(frame):
    df = frame("k string, o int", [("a", 2), ("a", 1), ("b", 5)])
    first = temporal.one_per_key(df, ["k"], [F.col("o")])
    assert rows(first) == [("a", 1), ("b", 5)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert ", 1, Partial" in plan and ", 1, Final" in plan


def test_calendar_has_every_day(frame):
    bounds = frame("a date, b date", [(dt.date(2026, 2, 27), dt.date(2026, 3, 2))])
    days = [r[0] for r in temporal.calendar(bounds, "a", "b").orderBy("date_day").collect()]
    assert days == [dt.date(2026, 2, 27), dt.date(2026, 2, 28), dt.date(2026, 3, 1), dt.date(2026, 3, 2)]
    assert temporal.calendar(frame("a date, b date", [(None, None)]), "a", "b").count() == 0


def test_the_interval_form_equals_the_time_line(spark):
    """Long and short versions over narrow bins, facts before, between and after versions, keys without facts, NULLs."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.xxhash64("id") % 900).cast("int"))
    facts = spark.range(4000).select("id", F.when(F.col("id") % 11 > 0, F.concat(F.lit("k"), F.col("id") % 9)).alias("k"),
                                     F.when(F.col("id") % 13 > 0, day).alias("d"))
    since = F.date_add(F.lit("2019-06-01").cast("date"), (F.col("id") * F.col("id") % 1500).cast("int"))
    history = spark.range(600).select(F.concat(F.lit("k"), F.col("id") % 12).alias("k"), since.alias("s"), F.col("id").alias("v"))
    history = history.groupBy("k", "s").agg(F.min("v").alias("v"))
    expected = asof_left_join(facts, history, "k", "d", "s", ["v"])
    for days in (7, 90, 5000):
        found = interval_left_join(facts, history, "k", "d", "s", ["v"], days=days)
        assert set(found.columns) == set(expected.columns)
        assert found.count() == 4000 and found.exceptAll(expected.select(found.columns)).count() == 0
    assert interval_left_join(facts.where("false"), history, "k", "d", "s", ["v"]).count() == 0
    assert interval_left_join(facts, history.where("false"), "k", "d", "s", ["v"]).where("v is null").count() == 4000


def test_versions_of_unobserved_keys_are_not_shuffled(spark):
    facts = spark.range(50).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit("2026-01-05").cast("date").alias("d"))
    dates = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    history = spark.range(0, 30_000, 1, 4).select(F.concat(F.lit("k"), F.col("id") % 3000).alias("k"), dates.alias("s"), "id")
    history = history.dropDuplicates(["k", "s"]).cache()
    assert maybe_among(history, facts, "k").select("k").distinct().count() < 60
    plan = asof_left_join(facts, history, "k", "d", "s", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("__bits")  # the filter is below the window and its exchange
