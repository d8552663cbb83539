"""The batch jobs (S8, Q9): land raw files, build the warehouse layer by layer, check each layer before the next.

    python -m claimloom.jobs --root /data/warehouse/2026-08-01 --claims DIR --reverts DIR --lookups DIR \\
        --pharmacies DIR --partners DIR --price-history FILE_OR_DIR

Giving every run its own root keeps the tables of the run before readable while this one writes.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimloom.plans import checks
from claimloom.plans.warehouse import Warehouse
from claimloom.sources import landing, tables

CONCURRENT_JOBS = 6
"""Independent tables of a layer are written side by side, so small ones fill the gaps the large ones leave."""

INTERMEDIATE_VIEWS = [
    "claims_scoped",
    "reverts_scoped",
    "lookups_resolved",
    "claim_cost",
    "claim_attribution",
    "claim_revert",
    "claim_economics",
]


class CheckFailed(Exception):
    def __init__(self, stage: str, violations: dict[str, int]):
        self.violations = violations
        listed = ", ".join(f"{name}: {n}" for name, n in sorted(violations.items()))
        super().__init__(f"checks failed after {stage}: {listed}")


@dataclass(frozen=True)
class Table:
    """``month_of``: the date by whose month it is partitioned; ``key``: what it is bucketed by, if tables are."""

    name: str
    layer: str
    month_of: str | None = None
    key: str | None = None


@dataclass(frozen=True)
class Stage:
    """Tables written side by side, then the checks that must pass before the next stage starts."""

    name: str
    tables: list[Table]
    gate: Callable[[Warehouse], list[DataFrame]]


def _gate(declared: dict[str, checks.TableChecks], *more: Callable[[Warehouse], list[DataFrame]]):
    return lambda wh: [*checks.table_checks(wh, declared), *(c for f in more for c in f(wh))]


def _only(declared: dict[str, checks.TableChecks], *names: str) -> dict[str, checks.TableChecks]:
    return {n: declared[n] for n in names}


STAGES = [
    Stage(
        "staging",
        [
            Table("claims_judged", "intermediate", key="claim_id"),
            Table("stg_price_history", "staging"),
            Table("stg_lookups", "staging", key="claim_id"),
            Table("stg_reverts", "staging", key="claim_id"),
            Table("stg_pharmacies", "staging"),
            Table("stg_partners", "staging"),
        ],
        _gate(checks.STAGING | _only(checks.INTERMEDIATE, "claims_scoped")),
    ),
    Stage(
        "claims",
        [
            Table("fct_claim", "marts", month_of="filled_date"),
            Table("reverts_judged", "intermediate"),
            Table("dim_drug", "marts"),
            Table("dim_date", "marts"),
            Table("dim_partner", "marts"),
            Table("dim_pharmacy", "marts"),
        ],
        _gate(
            _only(
                checks.INTERMEDIATE,
                "reverts_scoped",
                "lookups_resolved",
                "claim_cost",
                "claim_attribution",
                "claim_revert",
                "claim_economics",
            )
            | checks.DIMENSIONS
            | _only(checks.FACTS, "fct_claim")
        ),
    ),
    Stage(
        "lookups and quarantine",
        [Table("fct_lookup", "marts", month_of="lookup_date"), Table("dq_rejects", "marts")],
        _gate(_only(checks.FACTS, "fct_lookup", "dq_rejects"), checks.fact_invariants),
    ),
    Stage(
        "marts",
        [
            Table("mart_drug_economics", "marts"),
            Table("mart_partner_performance", "marts"),
            Table("mart_funnel_daily", "marts"),
        ],
        _gate(checks.MARTS),
    ),
]
# What each written table is built from, for selecting a table with all that depends on it.
BUILT_FROM = {
    "claims_judged": ["stg_pharmacies"],
    "fct_claim": ["claims_judged", "stg_lookups", "stg_reverts", "stg_partners", "stg_price_history"],
    "reverts_judged": ["claims_judged", "stg_reverts"],
    "dim_drug": ["claims_judged", "stg_lookups", "stg_price_history"],
    "dim_date": ["claims_judged", "stg_lookups", "stg_reverts"],
    "dim_partner": ["stg_partners"],
    "dim_pharmacy": ["stg_pharmacies"],
    "fct_lookup": ["stg_lookups", "fct_claim"],
    "dq_rejects": ["claims_judged", "reverts_judged", "stg_lookups"],
    "mart_drug_economics": ["dim_drug", "fct_claim", "fct_lookup"],
    "mart_partner_performance": ["dim_partner", "fct_claim", "fct_lookup"],
    "mart_funnel_daily": ["fct_claim", "fct_lookup"],
}

# Written tables that carry everything another model has: reading them replaces building that model.
STANDS_FOR = {"fct_claim": ["claim_outcome"]}


def _together(tasks: Iterable[Callable[[], object]]) -> list:
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def land(spark: SparkSession, paths: Mapping[str, str], root: str, files: int | None = None) -> dict[str, int]:
    """Land the six sources as text tables; returns their row counts. Unreadable records are rows too.

    ``files``: how many files the event tables are written as, for when they arrive as few large ones; else as many
    as arrive.
    """
    return land_tables(landing.read_raw(spark, dict(paths), spool=f"{root.rstrip('/')}/raw/_pieces"), root, files)


def land_tables(raw: Mapping[str, DataFrame], root: str, files: int | None = None) -> dict[str, int]:
    names = list(raw)
    frames = [raw[n].repartition(files) if files and n in landing.EVENT_FIELDS else raw[n] for n in names]
    counts = _together(
        [lambda n=n, df=df: tables.write_counted(df, root, "raw", n) for n, df in zip(names, frames)]
    )
    for name, df in zip(names, frames):
        tables.register(df, root, "raw", name)
    return dict(zip(names, counts))


def violations(results: list[DataFrame]) -> dict[str, int]:
    """Run checks, one row each, and return those with violations."""
    if not results:
        return {}
    rows = checks.union(results).where("violations > 0").collect()
    return {r.check_name: r.violations for r in rows}


def stop_if_violated(stage: str, results: list[DataFrame], allow: Collection[str] = ()) -> None:
    """Run checks and raise for violations of those that are not allowed to fail."""
    failed = {c: n for c, n in violations(results).items() if c not in allow}
    if failed:
        raise CheckFailed(stage, failed)


def build(
    spark: SparkSession,
    root: str,
    select: Collection[str] | None = None,
    reuse: str | None = None,
    run_checks: bool = True,
    allow: Collection[str] = (),
    buckets: int | None = None,
) -> Warehouse:
    """Build the warehouse from the landed tables under ``root``.

    ``select``: only these tables, layers or stages, with all that depends on them if the name ends in ``+``; other
    tables are read from ``reuse``, an earlier root, when it is given, else built as part of what needs them.
    ``buckets``: write the tables that are joined by claim id in so many buckets, so that attribution, reversals and the
    links of reversals and lookups need no shuffle; one bucket is one task, so choose it by the size of the claims.
    ``allow``: checks that may fail without stopping the build. A stage's tables get their catalog names when its
    checks have passed, so a failed build leaves readers with the tables of the last good one.
    """
    opened = _together([lambda n=n: tables.open_table(spark, root, "raw", n) for n in RAW])
    wh = Warehouse(dict(zip(RAW, opened)))
    wanted = selected(select)
    for stage in STAGES:
        chosen = [t for t in stage.tables if t.name in wanted]
        for t in stage.tables:
            if t not in chosen and reuse is not None:
                _put(wh, t.name, tables.open_table(spark, reuse, t.layer, t.name))
        if not chosen:
            continue
        written = _write(wh, chosen, root, buckets)
        if run_checks:
            stop_if_violated(stage.name, _chosen_checks(stage, wh, chosen), allow)
        for t, table in zip(chosen, written):
            bucketed = (t.key, buckets) if t.key and buckets else None
            tables.register(table, root, t.layer, t.name, t.month_of is not None, bucketed)
    for view in INTERMEDIATE_VIEWS:
        getattr(wh, view).createOrReplaceTempView(view)
    return wh


RAW = [*landing.EVENT_FIELDS, "pharmacies", "partners", "price_history"]


def _chosen_checks(stage: Stage, wh: Warehouse, chosen: list[Table]) -> list[DataFrame]:
    """All checks of a stage; a partly selected stage is checked on its own tables only."""
    if chosen == stage.tables:
        return stage.gate(wh)
    names = {t.name for t in chosen}
    return checks.table_checks(wh, {t: c for group in checks.ALL for t, c in group.items() if t in names})


def selected(select: Collection[str] | None) -> set[str]:
    """The names of the tables that a selection asks for."""
    every = [(t, stage) for stage in STAGES for t in stage.tables]
    if select is None:
        return {t.name for t, _ in every}
    known = {n for t, stage in every for n in (t.name, t.layer, stage.name)}
    if unknown := {s.removesuffix("+") for s in select} - known:
        raise ValueError(f"nothing is called {sorted(unknown)}")
    found = {t.name for t, stage in every if {t.name, t.layer, stage.name} & {s.removesuffix("+") for s in select}}
    grow = {t.name for t, stage in every for s in select if s.endswith("+") and s[:-1] in (t.name, t.layer, stage.name)}
    while grow:
        found |= grow
        grow = {t for t, sources in BUILT_FROM.items() if t not in found and set(sources) & grow}
    return found


def _write(wh: Warehouse, chosen: list[Table], root: str, buckets: int | None = None) -> list[DataFrame]:
    def write(t: Table, plan: DataFrame) -> DataFrame:
        if t.key and buckets:
            return tables.write_bucketed(plan, root, t.layer, t.name, t.key, buckets)
        return tables.write_table(plan, root, t.layer, t.name, t.month_of)

    # Plans first, in one thread; only the writing runs side by side.
    plans = [(t, getattr(wh, t.name)) for t in chosen]
    written = _together([lambda p=p: write(*p) for p in plans])
    for (t, _), table in zip(plans, written):
        _put(wh, t.name, table)
    return written


def _put(wh: Warehouse, name: str, table: DataFrame) -> None:
    table = table.drop("event_month")  # the folder name of a partitioned fact, not a column of the model
    wh.put(name, table)
    for other in STANDS_FOR.get(name, []):
        wh.put(other, table)
    if name == "claims_judged":
        wh.put("stg_claims", table.drop("chain", "scope_exclusion_reason"))


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="claimloom.jobs", description="Land event files and build the warehouse.")
    p.add_argument("--root", required=True, help="folder of this run's tables")
    for name in RAW:
        p.add_argument(f"--{name.replace('_', '-')}", help=f"path of the {name} files")
    p.add_argument("--files", type=int, help="files per landed event table, if fewer arrive")
    p.add_argument("--skip-land", action="store_true", help="build from tables already landed under the root")
    p.add_argument("--skip-build", action="store_true", help="land and stop")
    p.add_argument("--select", nargs="*", help="tables, layers or stages to build")
    p.add_argument("--buckets", type=int, help="write the tables joined by claim id in so many buckets")
    p.add_argument("--reuse", help="root of an earlier run, read for tables that are not selected")
    args = p.parse_args(argv)
    if not args.skip_land and not all(getattr(args, name) for name in RAW):
        p.error("landing needs a path for each of: " + ", ".join(RAW))
    return args


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("claims warehouse").getOrCreate()
    if not args.skip_land:
        counts = land(spark, {name: getattr(args, name) for name in RAW}, args.root, args.files)
        for name, rows in counts.items():
            print(f"landed raw.{name}: {rows:,} rows")
    if not args.skip_build:
        build(spark, args.root, args.select, args.reuse, buckets=args.buckets)
        print(f"warehouse built under {args.root}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
