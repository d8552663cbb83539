"""Every registered query against its SQL in DuckDB, and the shape of the plans that must scale."""

import compare
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from claimloom.bridge import registry, views
from claimloom.plans import checks
from claimloom.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = compare.duck(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert compare.compare(spark, duck, SF, name) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) <= set(contract.oracle_sql()) and set(registry.QUERIES) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["partner", "claims"]
    assert df.count() > 0


def test_declaring_the_models_starts_no_job(spark):
    tables = views.RawTables(spark, SF)
    for name in tables:
        tables[name]  # opening a file is a job of Spark's own
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    wh = Warehouse(tables)
    for model in ("fct_claim", "fct_lookup", "dq_rejects", "mart_funnel_daily", "claim_cost", "lookups_resolved"):
        getattr(wh, model)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_reason_counts_of_the_bridge(spark):
    got = dict(rows(registry.QUERIES["dq_classify_claims"](spark, "/root/testdata/sf0.01").groupBy("dq_reject_reason").count()))
    assert got.pop(None) == 29_333 + 2_925
    assert got == {
        "duplicate_claim_id": 24_571,
        "missing_required_field": 1_269,
        "unparseable_timestamp": 675,
        "unparseable_number": 626,
        "non_positive_amount": 601,
    }


def single_partition_windows(df) -> list[str]:
    """Windows whose rows are gathered in one task or share a constant key."""
    found = []

    def walk(node, below_window):
        name = node.nodeName()
        if below_window and name == "Exchange":
            partitioning = node.outputPartitioning().toString()
            if "SinglePartition" in partitioning or "#" not in partitioning:
                found.append(partitioning)
            below_window = False
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), name == "Window" or below_window)

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.inputPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan, False)
    return found


def physical(df):
    """The plan before adaptive execution wraps it."""
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name", ["fact_claim", "reject_share", "quarantine", "price_history"])
def test_no_cartesian_product_and_no_single_partition_window(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert "CartesianProduct" not in physical(df) and "BroadcastNestedLoopJoin" not in physical(df)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert single_partition_windows(registry.QUERIES[name](spark, SF)) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("keys", [[], ["constant"]])
def test_the_plan_test_sees_such_windows(spark, keys):
    over = Window.partitionBy(*(F.lit(k) for k in keys)).orderBy("id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert single_partition_windows(spark.range(9).withColumn("n", F.row_number().over(over)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def lost_claims(wh):
    return checks.row_conservation(wh).where("source_table = 'claims'").first().lost


def test_conservation_counts_the_real_fact(spark):
    wh = registry.warehouse(spark, SF)
    # A price version that is there twice neither multiplies nor loses claims, and is found by its own check.
    wh.put("stg_price_history", wh.stg_price_history.unionAll(wh.stg_price_history))
    assert lost_claims(wh) == 0
    keys = checks.union(checks.key_checks(wh, {"stg_price_history": checks.STAGING["stg_price_history"]}))
    assert keys.where("violations > 0").count() == 1
    wh.put("fct_claim", wh.fct_claim.unionAll(wh.fct_claim.limit(1)))
    assert lost_claims(wh) == -1


def test_pruning_reaches_the_scan(spark):
    plan = registry.QUERIES["duplicate_ids"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_few_parts_are_dealt_by_hash_and_many_are_read_as_they_are(spark, tmp_path):
    """A round-robin deal would sort the whole table in the task that reads it."""
    table = spark.range(1000).selectExpr("id", "id % 7 AS k")
    for name, parts in (("one", 1), ("many", 40)):
        table.repartition(parts).write.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        one, many = (views.dealt(spark.read.parquet(str(tmp_path / n)), "id") for n in ("one", "many"))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (one, many)]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "hashpartitioning(id" in plans[0] and "RoundRobin" not in plans[0]
    assert "Exchange" not in plans[1]
    assert one.count() == many.count() == 1000


@pytest.mark.parametrize("name", ["split_violations", "net_zero_violations", "row_conservation", "enum_violations"])
def test_tables_read_once_are_not_kept(spark, name):
    spark.catalog.clearCache()
    plan = registry.QUERIES[name](spark, contract.SMOKE_DIR)._jdf.queryExecution().withCachedData().toString()
    assert "InMemoryRelation" not in plan


def test_kept_claims_have_no_raw_texts(spark):
    spark.catalog.clearCache()
    plan = registry.QUERIES["key_violations"](spark, contract.SMOKE_DIR)._jdf.queryExecution().withCachedData().toString()
    kept = [line for line in plan.splitlines() if "InMemoryRelation" in line]
    spark.catalog.clearCache()
    assert kept and not any("price_raw" in line for line in kept)
