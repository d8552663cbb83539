"""Tables written in buckets of the claim id are joined by it without a shuffle."""

import pytest
from conftest import rows

from claimloom import jobs
from claimloom.bridge import views
from claimloom.plans.warehouse import Warehouse
from claimloom.sources import tables

SF = "/root/testdata/sf0.001"
HUB = ["claims_judged", "stg_reverts", "stg_lookups"]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = views.RawTables(spark, SF)
    plain, bucketed = Warehouse(raw), Warehouse(raw)
    root = str(tmp_path_factory.mktemp("hub"))
    for name in ("stg_partners", "stg_price_history"):
        table = tables.write_table(getattr(plain, name), root, "staging", name)
        plain.put(name, table)
        bucketed.put(name, table)
    for name in HUB:
        table = tables.write_bucketed(getattr(plain, name), root, "staging", name, "claim_id", 4)
        plain.put(name, tables.open_table(spark, root, "staging", name))
        bucketed.put(name, table)
    return plain, bucketed


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "hashpartitioning(claim_id" in line and "Exchange" in line]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("model", ["fct_claim", "fct_lookup", "reverts_judged", "claim_revert"])
def test_no_exchange_on_the_claim_id(spark, built, no_broadcast, model):
    plain, bucketed = (getattr(wh, model) for wh in built)
    assert exchanges(plain) and not exchanges(bucketed)


@pytest.mark.parametrize("model", ["fct_claim", "fct_lookup"])
def test_the_rows_are_the_same(spark, built, model):
    plain, bucketed = (getattr(wh, model) for wh in built)
    assert plain.count() == bucketed.count() and plain.exceptAll(bucketed).count() == 0


def test_rows_without_a_key_are_written_by_many_tasks(spark, tmp_path):
    df = spark.sql("select id, cast(null as string) as k from range(0, 4000, 1, 4)")
    table = tables.write_bucketed(df, str(tmp_path), "staging", "none", "k", 4)
    assert table.count() == 4000 and len(list((tmp_path / "staging" / "none").glob("*.parquet"))) == 4


def test_a_build_in_buckets(spark, tmp_path):
    roots = [str(tmp_path / n) for n in ("plain", "bucketed")]
    for root, buckets in zip(roots, (None, 3)):
        jobs.land_tables(views.RawTables(spark, SF), root)
        jobs.build(spark, root, run_checks=False, buckets=buckets)
        for name in ("staging.stg_lookups", "intermediate.claims_judged"):
            told = rows(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'"), "data_type")
            assert told == ([("3",)] if buckets else [])
    for name in ("mart_partner_performance", "fct_lookup", "dq_rejects"):
        one, other = (tables.open_table(spark, root, "marts", name) for root in roots)
        assert rows(one) == rows(other)
