"""Late events without a full reload (S7, D9): only the months that late rows can change are rebuilt.

A late row changes the claims it names. A reversal or claim whose id was there before makes the earlier one ambiguous as
well, so what that one named changes too. The ids of all these claims are the changed keys; the months of their fills,
before and after, are the touched months of the claim fact, and the months of the lookups that name them those of the
lookup fact. Touched months are computed again from the staged rows and overwrite their own partitions; no file of
another month is read for it or written. Staged tables are patched by key, what is small is built again.

The late rows join the landed tables last, so a refresh that broke off can be run again, and a full build afterwards
gives the same tables.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import jobs
from claimloom.functions import clean_text
from claimloom.operators.assertions import count_violations
from claimloom.operators.joins import attach
from claimloom.plans import checks, scope, staging
from claimloom.plans.warehouse import Warehouse
from claimloom.sources import tables

SMALL = ["dim_drug", "dim_date", "dq_rejects", "mart_drug_economics", "mart_partner_performance", "mart_funnel_daily"]
"""Tables built again as a whole: dimensions, the quarantine and aggregates."""


def _ids(raw: DataFrame, out: str) -> DataFrame:
    return raw.select(clean_text("id").alias(out)).where(F.col(out).isNotNull()).distinct()


def _patched(old: DataFrame, fresh: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The staged rows with those of some ids judged anew; rows without an id are never judged against each other."""
    return attach(old, ids, key, "left_anti", keyless=True).unionByName(fresh)


def _month(day: str):
    return F.trunc(day, "month")


def _months(*frames: DataFrame) -> list[date]:
    """The distinct months of one-column frames: a bounded list."""
    rows = checks.union([f.toDF("m") for f in frames]).distinct().collect()
    return sorted(r.m for r in rows if r.m is not None)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _replace(df: DataFrame, root: str, layer: str, name: str) -> DataFrame:
    """Overwrite a table that the new rows are computed from: written beside it and renamed."""
    spark, path = df.sparkSession, tables.path_of(root, layer, name)
    tables.write_table(df, root, layer, f"_{name}.next")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    _delete(spark, path)
    fresh = hadoop(tables.path_of(root, layer, f"_{name}.next"))
    if not fresh.getFileSystem(spark._jsc.hadoopConfiguration()).rename(fresh, hadoop(path)):
        raise OSError(f"{path} could not be replaced")
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def overwrite_months(fact: DataFrame, root: str, name: str, months: Collection[date]) -> None:
    """Overwrite these months of a fact, and no others; a month without rows loses its files."""
    spark = fact.sparkSession
    path = tables.path_of(root, "marts", name)
    monthly = fact.hint("rebalance", "event_month")
    writer = monthly.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_month")
    writer.parquet(path)
    filled = {r.event_month for r in spark.read.parquet(path).where(F.col("event_month").isin(list(months)))
              .join(fact.select("event_month").distinct(), "event_month", "left_semi").select("event_month").distinct().collect()}
    for month in months:
        if month not in filled:
            _delete(spark, f"{path}/event_month={month}")
    spark.catalog.refreshByPath(path)


def refresh(
    spark: SparkSession, root: str, late: Mapping[str, DataFrame], allow: Collection[str] = ()
) -> dict[str, list[date]]:
    """Add late raw rows (claims, reverts, lookups, as they are landed) to a built warehouse under ``root``.

    Returns the months rebuilt per fact. Checks run as after a build; the split and net-zero checks of the claim fact
    run on its new rows before they are written. ``allow``: checks that may fail.
    """
    raw = {n: tables.open_table(spark, root, "raw", n) for n in jobs.RAW}
    shape = {n: raw[n].schema for n in late}
    late = {
        n: tables.write_table(
            df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(shape[n][c].dataType).alias(c) for c in shape[n].names)),
            root, "raw", f"_late_{n}",
        )
        for n, df in late.items()
    }
    none = {n: raw[n].where("false") for n in ("claims", "reverts", "lookups")}
    new = {n: late.get(n, none.get(n)) for n in none}
    everything = {n: raw[n].unionByName(new[n]) if n in new else raw[n] for n in raw}

    # Staged rows again for the ids that arrived late.
    def of(source: str, ids: DataFrame, key: str) -> DataFrame:
        rows = everything[source].withColumn("__key", clean_text("id"))
        return rows.join(ids.withColumnRenamed(key, "__key"), "__key", "left_semi").drop("__key").unionByName(
            new[source].where(clean_text("id").isNull())
        )

    wh = Warehouse(everything)
    opened = {t.name: tables.open_table(spark, root, t.layer, t.name) for s in jobs.STAGES for t in s.tables}
    for name in ("stg_pharmacies", "stg_partners", "stg_price_history", "dim_partner", "dim_pharmacy"):
        wh.put(name, opened[name])
    claim_ids, revert_ids = _ids(new["claims"], "claim_id"), _ids(new["reverts"], "revert_id")
    judged = scope.judge_claims(staging.claims(of("claims", claim_ids, "claim_id")), wh.stg_pharmacies)
    reverts = staging.reverts(of("reverts", revert_ids, "revert_id"))
    lookups = staging.lookups(new["lookups"])
    named = [claim_ids, reverts.select("claim_id"), lookups.select("claim_id")]
    earlier = opened["stg_reverts"].join(revert_ids, "revert_id", "left_semi").select("claim_id")
    changed = checks.union([*named, earlier]).where(F.col("claim_id").isNotNull()).distinct()
    changed = tables.write_table(changed, root, "raw", "_changed")

    patched = {
        "claims_judged": ("intermediate", _patched(opened["claims_judged"], judged, claim_ids, "claim_id")),
        "stg_reverts": ("staging", _patched(opened["stg_reverts"], reverts, revert_ids, "revert_id")),
        "stg_lookups": ("staging", opened["stg_lookups"].unionByName(lookups)),
    }
    for name, (_, df) in patched.items():
        jobs._put(wh, name, df)
    before = opened["fct_claim"].join(changed, "claim_id", "left_semi").select(_month("filled_date"))
    after = wh.analysable.join(changed, "claim_id", "left_semi").select(_month("filled_date"))
    months = {"fct_claim": _months(before, after)}
    naming = wh.clean_lookups.join(changed, "claim_id", "left_semi")
    arrived = lookups.where(F.col("dq_reject_reason").isNull())
    months["fct_lookup"] = _months(naming.select(_month("lookup_date")), arrived.select(_month("lookup_date")))

    # The claim fact of its touched months, from the staged claims of those months.
    whole = wh.claims_judged
    wh.put("claims_judged", whole.where(_month("filled_date").isin(months["fct_claim"])))
    fresh = wh.fct_claim.withColumn("event_month", _month("filled_date"))
    fresh = tables.write_table(fresh, root, "marts", "_fct_claim.next")
    predicates = checks.split_predicates() | checks.net_zero_predicates()
    jobs.stop_if_violated("late rows", [count_violations(fresh, predicates)], allow)
    overwrite_months(fresh, root, "fct_claim", months["fct_claim"])

    # From here on the written tables.
    wh = Warehouse(everything)
    for name in opened:
        if name not in (*SMALL, "reverts_judged", "fct_lookup", *patched):
            jobs._put(wh, name, tables.open_table(spark, root, *_at(name)))
    for name, (layer, df) in patched.items():
        jobs._put(wh, name, _replace(df, root, layer, name))
    jobs._put(wh, "reverts_judged", _replace(wh.reverts_judged, root, "intermediate", "reverts_judged"))
    in_months = wh.stg_lookups.where(_month("lookup_date").isin(months["fct_lookup"]))
    part = Warehouse(everything)
    part.put("stg_lookups", in_months)
    part.put("claim_outcome", wh.fct_claim)
    fresh = part.fct_lookup.withColumn("event_month", _month("lookup_date"))
    overwrite_months(tables.write_table(fresh, root, "marts", "_fct_lookup.next"), root, "fct_lookup", months["fct_lookup"])
    jobs._put(wh, "fct_lookup", tables.open_table(spark, root, "marts", "fct_lookup"))
    for name in SMALL:
        jobs._put(wh, name, _replace(getattr(wh, name), root, "marts", name))
    found = [*checks.table_checks(wh, checks.FACTS | checks.MARTS | checks.DIMENSIONS), *checks.fact_invariants(wh)]
    jobs.stop_if_violated("late rows", found, allow)
    for n, df in late.items():
        df.write.mode("append").parquet(tables.path_of(root, "raw", n))
        spark.catalog.refreshByPath(tables.path_of(root, "raw", n))
    for s in jobs.STAGES:
        for t in s.tables:
            if spark.catalog.tableExists(f"{t.layer}.{t.name}"):
                if t.month_of:
                    spark.sql(f"MSCK REPAIR TABLE {t.layer}.{t.name} SYNC PARTITIONS")
                spark.catalog.refreshTable(f"{t.layer}.{t.name}")
    return months


def _at(name: str) -> tuple[str, str]:
    return next((t.layer, t.name) for s in jobs.STAGES for t in s.tables if t.name == name)
