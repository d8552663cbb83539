"""The many-to-one join under a hot key, rows without key and both roles of the unique side."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom.operators import joins
from claimloom.operators.joins import attach


def skewed(spark, n=30_000):
    """A third of the rows on one key, a third without key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, n, 1, 8).select("id", key.alias("k"))


def unique_side(spark):
    return spark.range(0, 400, 1, 2).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("v")
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("reference", [True, False])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_equals_plain_join(spark, how, reference):
    many, one = skewed(spark), unique_side(spark)
    expected = many.join(one, "k", how)
    got = attach(many, one, "k", how, reference=reference)
    assert got.columns == expected.columns
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_key_are_spread(spark, how):
    none = spark.range(0, 8000, 1, 8).select("id", F.lit(None).cast("string").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(none, unique_side(spark), "k", how).select("*", F.spark_partition_id().alias("p"))
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) <= 6000 and len(sizes) > 1


def test_the_plan_follows_the_role_not_the_size(spark):
    many, one = skewed(spark), unique_side(spark).limit(1)
    assert "BroadcastHashJoin" in plan_of(attach(many, one, "k", reference=True))
    shuffled = plan_of(attach(many, one, "k"))
    assert "SortMergeJoin" in shuffled and "BroadcastHashJoin" not in shuffled


def test_a_reference_table_that_is_none_fails(spark, monkeypatch):
    monkeypatch.setattr(joins, "REFERENCE_ROWS", 100)
    joined = attach(skewed(spark), unique_side(spark), "k", reference=True)
    with pytest.raises(Exception, match="reference table has more than 100 rows"):
        joined.count()


def test_declaring_a_join_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    many, one = skewed(spark), unique_side(spark)
    attach(many, one, "k")
    attach(many, one, "k", reference=True)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_empty_input(spark):
    empty = skewed(spark).where("false")
    assert attach(empty, unique_side(spark), "k").count() == 0
    assert attach(skewed(spark), unique_side(spark).where("false"), "k").where("v is not null").count() == 0


def test_composite_key(spark):
    many = skewed(spark).withColumn("d", F.col("id") % 2)
    one = unique_side(spark).withColumn("d", F.lit(0).cast("bigint"))
    got = attach(many, one, ["k", "d"])
    assert rows(got.groupBy().agg(F.count("v"), F.sum("v"))) == rows(
        many.join(one, ["k", "d"], "left").groupBy().agg(F.count("v"), F.sum("v"))
    )


def sizes_by_task(df):
    return [r["count"] for r in df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()]


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_a_key_are_not_shuffled(spark, how):
    """Two thirds of a mixed table have no key: in a plain join they meet in one task."""
    key = F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id") % 5000))
    mixed = spark.range(0, 60_000, 1, 8).select("id", key.alias("k"))
    one = spark.range(0, 3000, 1, 2).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, split = attach(mixed, one, "k", how), attach(mixed, one, "k", how, keyless=True)
        assert max(sizes_by_task(plain)) >= 40_000
        assert max(sizes_by_task(split)) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert split.columns == plain.columns and split.exceptAll(plain).count() == 0 and split.count() == plain.count()


def test_composite_keys_without_a_part(spark):
    many = skewed(spark).withColumn("d", F.when(F.col("id") % 2 == 0, F.lit(0).cast("bigint")))
    one = unique_side(spark).withColumn("d", F.lit(0).cast("bigint"))
    plain, split = (attach(many, one, ["k", "d"], keyless=keyless) for keyless in (False, True))
    assert plain.exceptAll(split).count() == 0 and plain.count() == split.count()


def test_the_key_filter_keeps_every_wanted_row_and_few_others(spark):
    rows_ = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), "id")
    wanted = spark.range(0, 200_000, 1000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    kept = joins.maybe_among(rows_.union(spark.sql("select cast(null as string), -1L")), wanted, "k")
    assert kept.join(wanted, "k", "left_semi").count() == 200
    assert 200 <= kept.count() < 300
    assert joins.maybe_among(rows_, wanted.where("false"), "k").count() == 0


def test_a_crowded_key_filter_only_lets_more_pass(spark, monkeypatch):
    monkeypatch.setattr(joins, "FILTER_WORDS", 2)
    rows_ = spark.range(5000).select(F.col("id").alias("k"))
    kept = joins.maybe_among(rows_, spark.range(0, 5000, 2).select(F.col("id").alias("k")), "k")
    assert kept.where("k % 2 = 0").count() == 2500
