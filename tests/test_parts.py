"""Large tables are shuffled into parts that grow in number with the batch."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom.operators import classify, joins, temporal
from claimloom.plans import economics, facts, scope, staging

CLAIMS = "id string, npi string, ndc string, price string, quantity string, pbm_fee string, timestamp string, _source_file string"
LOOKUPS = "claim_id string, looked_up_at timestamp, lookup_id string, partner string, channel string"
REVERTS = "id string, claim_id string, timestamp string, _source_file string"
PRICES = (
    "ndc string, ndc_description string, unit_price string, effective_date string, as_of_date string, pricing_unit string, "
    "classification string, otc string, generic_unit_price string"
)
TERMS = "partner string, fee_model string, flat_fee_cents bigint, fee_rate double"


@pytest.fixture
def tables(frame):
    claims = [(f"c{i % 40}" if i % 9 else None, "1", f"n{i % 5}", "10", "2", "1", f"2024-01-{i % 28 + 1:02d}T00:00:00", "f") for i in range(60)]
    reverts = [(f"r{i}", f"c{i}", "2024-03-01T00:00:00", "f") for i in range(0, 50, 3)]
    prices = [(f"n{i % 4}", "d", str(i + 1), f"01/{i + 1:02d}/2024", "1/30/2024", "EA", "B", "Y", None) for i in range(20)]
    lookups = frame(LOOKUPS, [(f"c{i}", None, f"l{i}", "p", None) for i in range(0, 40, 2)])
    return frame(CLAIMS, claims), frame(REVERTS, reverts), frame(PRICES, prices), lookups, frame(TERMS, [("p", "flat", 30, None)])


def fact(tables, parts, resolve=None):
    claims, reverts, prices, lookups, terms = tables
    staged = staging.claims(claims, parts).where("dq_reject_reason IS NULL").withColumn("chain", F.lit("x"))
    reversed_ = staging.reverts(reverts, parts).where("dq_reject_reason IS NULL")
    outcome = facts.claim_outcome(
        staged, economics.attribution(lookups, parts), terms, economics.first_reverts(reversed_, parts)
    )
    prices = staging.price_history(prices, parts)
    if resolve:
        return economics.with_cost(staged, prices, resolve, parts)
    return facts.claim_fact(outcome, prices, parts)


def test_parts_grow_with_the_rows():
    assert joins.parts_for(10, 12) == 12
    assert joins.parts_for(36_000_000, 12) == 144
    assert joins.parts_for(216_000_000, 12) == joins.UNSORTED_PARTS
    assert joins.parts_for(2_400_000_000, 12) == 2000


@pytest.mark.parametrize("resolve", [None, temporal.interval_left_join])
def test_parts_change_no_row(tables, resolve):
    got = rows(fact(tables, 7, resolve))
    assert got and got == rows(fact(tables, None, resolve))


def test_repeats_are_counted_over_all_rows(frame):
    df = frame("k string", [("a",), ("a",), ("b",), (None,), (None,)])
    assert rows(classify.with_repeats(df, "k", parts=7)) == rows(classify.with_repeats(df, "k"))


def test_rows_are_shuffled_by_claim_id_into_the_parts_only(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact(tables, 7)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert set(re.findall(r"hashpartitioning\(claim_id#\d+, (\d+)\)", plan)) == {"7"}


@pytest.mark.parametrize("resolve, shuffles", [(temporal.asof_left_join, 3), (temporal.interval_left_join, 3)])
def test_the_facts_are_shuffled_once_for_their_keys(frame, resolve, shuffles):
    """Of a join behind the facts, the filter of the history and the pairs or the last day read one shuffle. The others
    are those of whole rows and of ``known``."""
    dated = frame("id bigint, k string, day int, w string", [(i, f"k{i % 5}", i, "w") for i in range(50)])
    dated = dated.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))
    known = frame("id bigint, n bigint", [(i, 1) for i in range(40)])
    known = joins.spread(known, "id", 7).groupBy("id").agg(F.sum("n").alias("n"))
    joined = joins.attach(joins.spread(dated, "id", 7), known, "id").where("coalesce(n, 0) < 2")
    history = frame("k string, v string", [(f"k{i}", "v") for i in range(9)])
    history = history.withColumn("s", F.lit("2024-01-05").cast("date"))
    found = resolve(joined, history, "k", "d", "s", ["v"], parts=7)
    executed = found._jdf.queryExecution().executedPlan()
    assert executed.execute().count() == 50
    made = r"ShuffleQueryStage \d+\n[ :+-]*Exchange hashpartitioning\(id#\d+L, 7\), REPARTITION_BY_NUM"
    assert len(re.findall(made, executed.toString())) == shuffles


def test_lookup_facts_and_judged_reversals_are_shuffled_into_the_parts_only(spark, tables):
    """What joins lookups or reversals to the claims takes the parts of the claims, not the number of the session."""
    claims, reverts, _, lookups, terms = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = staging.claims(claims, 7).where("dq_reject_reason IS NULL").withColumn("chain", F.lit("x"))
        reversed_ = staging.reverts(reverts, 7)
        clean = reversed_.where("dq_reject_reason IS NULL")
        outcome = facts.claim_outcome(staged, economics.attribution(lookups, 7), terms, economics.first_reverts(clean, 7))
        looked = lookups.withColumns({"ndc": F.lit("n"), "lookup_date": F.lit(None), "partner_was_missing": F.lit(False), "_source_file": F.lit("f")})
        found = [facts.lookup_fact(looked, outcome), scope.judge_reverts(reversed_, staged)]
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in found]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        assert set(re.findall(r"hashpartitioning\((?:claim|revert)_id#\d+, (\d+)\)", plan)) == {"7"}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("resolve", [temporal.asof_left_join, temporal.interval_left_join])
def test_price_histories_are_shuffled_once(tables, no_broadcast, resolve):
    """By item, for their own duplicates and for the as-of join; the other shuffle by item alone is that of the probes."""
    plan = planned(fact(tables, 7, resolve))
    assert "unit_cost_usd" in plan
    assert not re.findall(r"hashpartitioning\(ndc#\d+, effective_date#\d+, 7\)", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(ndc#\d+, 7\)", plan)) == (2 if resolve is temporal.asof_left_join else 1)


def test_filter_by_keys_asks_nothing_more_of_the_rows(spark):
    """So that the shuffle of a history is the same for a reader without the filter, and is made once."""
    history = spark.range(50).selectExpr("cast(id % 7 as string) k", "id v").repartition(3, "k")
    found = joins.maybe_among(history, spark.range(3).selectExpr("cast(id as string) k"), "k")
    assert {r.k for r in found.collect()} >= {"0", "1", "2"}
    assert "isnotnull(pmod" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_wide_rows_are_not_sorted_for_their_repeats(tables, no_broadcast):
    plan = planned(staging.claims(tables[0], 7))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_claims_that_are_not_judged_tell_which_versions_are_left_out(tables, no_broadcast):
    claims, _, prices, *_ = tables
    staged, prices = staging.claims(claims, 7).where("dq_reject_reason IS NULL"), staging.price_history(prices, 7)
    seen = staging.typed_claims(claims)
    found = economics.with_cost(staged, prices, temporal.interval_left_join, 7, seen=seen)
    plain = economics.with_cost(staged, prices, temporal.interval_left_join)
    assert rows(found) and rows(found) == rows(plain)
    wide, narrow = (len(re.findall(r"Exchange hashpartitioning\(claim_id#\d+, 7\)", planned(f))) for f in (
        economics.with_cost(staged, prices, temporal.interval_left_join, 7), found))
    assert narrow < wide
