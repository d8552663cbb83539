"""All models of the warehouse as lazy DataFrames over six raw tables.

A model is built on first use and remembered as a plan, not as data. Once a model has been written, ``put`` replaces
its plan by the written table, and whatever is built after that reads the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.plans import dims, economics, facts, marts, quarantine, scope, staging

Model = Callable[["Warehouse"], DataFrame]


def _model(build: Model) -> property:
    name = build.__name__

    def read(self: Warehouse) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build(self)
        return self._frames[name]

    return property(read, doc=build.__doc__)


class Warehouse:
    def __init__(self, raw: Mapping[str, DataFrame], parts: int | None = None):
        """``parts``: into how many parts the large tables are shuffled; None: as the session is set."""
        self.raw = raw
        self.parts = parts
        self._frames: dict[str, DataFrame] = {}

    def put(self, name: str, table: DataFrame) -> None:
        self._frames[name] = table

    # Staging: one source each.

    @_model
    def stg_claims(self):
        return staging.claims(self.raw["claims"], self.parts)

    @_model
    def stg_reverts(self):
        return staging.reverts(self.raw["reverts"], self.parts)

    @_model
    def stg_lookups(self):
        return staging.lookups(self.raw["lookups"])

    @_model
    def stg_pharmacies(self):
        return staging.pharmacies(self.raw["pharmacies"])

    @_model
    def stg_partners(self):
        return staging.partners(self.raw["partners"])

    @_model
    def stg_price_history(self):
        return staging.price_history(self.raw["price_history"], self.parts)

    # Intermediate: rules that need a second table.

    @_model
    def claims_judged(self):
        return scope.judge_claims(self.stg_claims, self.stg_pharmacies)

    @_model
    def claims_scoped(self):
        return scope.claims_scoped(self.claims_judged)

    @property
    def analysable(self) -> DataFrame:
        """The hub: claims that are well formed and in scope, with their chain."""
        return scope.analysable(self.claims_judged)

    @_model
    def reverts_judged(self):
        return scope.judge_reverts(self.stg_reverts, self.analysable)

    @_model
    def reverts_scoped(self):
        return scope.reverts_scoped(self.reverts_judged)

    @_model
    def lookups_resolved(self):
        return scope.lookups_resolved(self.stg_lookups, self.analysable)

    @property
    def clean_reverts(self) -> DataFrame:
        return self.stg_reverts.where(F.col("dq_reject_reason").isNull())

    @property
    def clean_lookups(self) -> DataFrame:
        return self.stg_lookups.where(F.col("dq_reject_reason").isNull())

    @_model
    def claim_cost(self):
        claims = self.analysable.drop("dq_reject_reason", "scope_exclusion_reason", "chain")
        return economics.with_cost(claims, self.stg_price_history, parts=self.parts)

    @_model
    def claim_attribution(self):
        return economics.attribution(self.lookups_resolved, self.parts)

    @_model
    def claim_revert(self):
        known = self.reverts_scoped.where(F.col("scope_exclusion_reason").isNull())
        return economics.first_reverts(known, self.parts)

    @_model
    def claim_economics(self):
        return economics.fee_economics(
            self.analysable, economics.attribution(self.clean_lookups, self.parts), self.stg_partners
        )

    # Marts.

    @_model
    def dim_pharmacy(self):
        return dims.pharmacy_dim(self.stg_pharmacies)

    @_model
    def dim_partner(self):
        return dims.partner_dim(self.stg_partners)

    @_model
    def dim_drug(self):
        return dims.drug_dim(self.analysable, self.clean_lookups, self.stg_price_history)

    @_model
    def dim_date(self):
        reverts = dims.revert_bounds(self.clean_reverts, self.analysable)
        return dims.date_dim(self.analysable, self.clean_lookups, reverts)

    @_model
    def claim_outcome(self):
        """The claim fact without cost columns, for whatever does not need them."""
        return facts.claim_outcome(
            self.analysable,
            economics.attribution(self.clean_lookups, self.parts),
            self.stg_partners,
            economics.first_reverts(self.clean_reverts, self.parts),
        )

    @_model
    def fct_claim(self):
        return facts.claim_fact(self.claim_outcome, self.stg_price_history, self.parts)

    @_model
    def fct_lookup(self):
        return facts.lookup_fact(self.clean_lookups, self.claim_outcome)

    @_model
    def dq_rejects(self):
        events = {source: self.raw[source] for source in quarantine.PAYLOADS}
        return quarantine.quarantine(self.claims_judged, self.reverts_judged, self.stg_lookups, events)

    @_model
    def mart_partner_performance(self):
        return marts.partner_performance(self.dim_partner, self.fct_claim, self.fct_lookup)

    @_model
    def mart_drug_economics(self):
        return marts.drug_economics(self.dim_drug, self.fct_claim, self.fct_lookup)

    @_model
    def mart_funnel_daily(self):
        return marts.funnel_daily(self.claim_outcome, self.fct_lookup)
