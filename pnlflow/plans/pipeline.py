"""The whole customer P&L job (D11) as a chain of lazily built DataFrames.

Every stage is a property built once per ``Stages`` object.  The ledger is read
once: after both dimensions are attached its rows are stored (``flagged``), and
pool, totals, spread and allocation read that table.  The stages that only
report a part of it (``ledger_product``, ``orphan_sku``, ...) are not on the
job's path.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.operators import allocate, enrich, fx, ledger, output, planning, reconcile, reporting
from pnlflow.operators.joins import stored, tasks_for
from pnlflow import rules
from pnlflow.plans.figures import Figures
from pnlflow.rules import JobParams
from pnlflow.sources.inputs import Inputs

CASCADE_LEVELS = ["sku", "ff", "bsp", "category"]
SCOPE = ["country", "period_year"]
SIGN_GROUP = ["sku", "country", "period_year", "sales_order"]


class Stages:
    def __init__(self, inputs: Inputs, params: JobParams, figures: Figures | None = None):
        self.i = inputs
        self.p = params
        self.figures = figures

    def _watch(self, df: DataFrame, name: str, **sums) -> DataFrame:
        return df if self.figures is None else self.figures.watch(df, name, **sums)

    @functools.cached_property
    def reporting_tasks(self) -> int:
        return tasks_for(self.i.reporting_facts)

    @functools.cached_property
    def union_tasks(self) -> int:
        return tasks_for(self.i.ledger_lines, self.i.reporting_facts)

    # --- actuals: ledger -> allocated customer rows ---------------------------
    @functools.cached_property
    def ledger_base(self) -> DataFrame:  # stage 1
        return ledger.ledger_base(self.i.ledger_lines, self.p)

    @functools.cached_property
    def ledger_conformed(self) -> DataFrame:  # stage 2
        return ledger.conform(self.ledger_base, self.p)

    @functools.cached_property
    def product_dim(self) -> DataFrame:  # stage 3
        return stored(enrich.product_dim(self.i.product_hier, self.i.brand_hier))

    @functools.cached_property
    def customer_dim(self) -> DataFrame:  # stage 4
        return stored(enrich.customer_dim(self.i.customer_flat, self.i.customer_area, self.i.customer_dim, self.p))

    @functools.cached_property
    def ledger_product(self) -> DataFrame:  # stage 5
        return enrich.attach_product(self.ledger_conformed, self.product_dim)

    @functools.cached_property
    def orphan_sku(self) -> DataFrame:  # stage 6
        return enrich.orphan_report(self.ledger_conformed, self.product_dim, "sku", ["period_year", "sku"])

    @functools.cached_property
    def ledger_product_customer(self) -> DataFrame:  # stage 7
        return enrich.attach_customer(self.ledger_product, self.customer_dim)

    @functools.cached_property
    def orphan_customer(self) -> DataFrame:  # stage 8
        return enrich.orphan_report(self.ledger_product, self.customer_dim, "customer", ["period_year", "sku"])

    @functools.cached_property
    def orphan_pool(self) -> DataFrame:  # stage 9
        cols = ["period_year", "sku", *enrich.MEASURES]
        return (self.orphan_sku.select(*cols).unionByName(self.orphan_customer.select(*cols))
                .groupBy("period_year").agg(F.sum("cogs_manufacturing").alias("pool_cost")))

    @functools.cached_property
    def flagged(self) -> DataFrame:  # stages 5-8 in one pass; the job reads the ledger through this table only
        return stored(enrich.attach_dimensions(self.ledger_conformed, self.product_dim, self.customer_dim))

    @functools.cached_property
    def period_totals(self) -> DataFrame:  # stage 9 and the totals of stage 12
        totals = enrich.orphan_totals(self.flagged)
        return stored(self._watch(totals, "pool", pool_cost=F.when(F.col("period_volume") != 0, F.col("pool_cost"))))

    @functools.cached_property
    def pool_spread(self) -> DataFrame:  # stages 10-13
        rows = self.flagged.where("has_product").drop(*enrich.MATCHES)
        args = (rows, self.period_totals, "period_year", "volume_net", "cogs_manufacturing", "pool_cost", "period_volume")
        if self.figures is None:
            return allocate.spread_pool(*args)
        spread = allocate.spread_pool(*args, parts=True)
        return self._watch(spread, "spread", before="__before", after="cogs_manufacturing",
                           unborne=F.when(F.col("__before").isNull(), F.col("__share"))).drop("__before", "__share")

    @functools.cached_property
    def sign_table(self) -> allocate.SignTable:  # stage 14: the rows that all allocation reads, stored once
        return allocate.sign_table(self.pool_spread, SIGN_GROUP, ["sku", *SCOPE], "volume_net", counted=self.flagged.where("has_product"))

    @functools.cached_property
    def cascade_factors(self) -> DataFrame:  # stages 15-16, per allocation cell; stored so that its size is known
        return stored(allocate.cascade_factors([df for df, _ in self.sign_table.positive], CASCADE_LEVELS, SCOPE,
                                               "volume_net", "cogs_manufacturing", self.union_tasks))

    @functools.cached_property
    def positive_parts(self) -> list[DataFrame]:  # stage 17
        return [allocate.apply_factors(df, self.cascade_factors, [*CASCADE_LEVELS, *SCOPE], "volume_net", "cost_share")
                for df, _ in self.sign_table.positive]

    @functools.cached_property
    def negative_parts(self) -> list[DataFrame]:  # stages 18-19
        return [allocate.prorate_within(df, ["sku", *SCOPE], "volume_net", "cogs_manufacturing", "cost_share", bounded)
                for df, bounded in self.sign_table.negative]

    @property
    def positive_allocated(self) -> DataFrame:
        return allocate.union_all(self.positive_parts)

    @property
    def negative_allocated(self) -> DataFrame:
        return allocate.union_all(self.negative_parts)

    @functools.cached_property
    def actuals_customer(self) -> DataFrame:  # stage 20
        # read by the reconciliation and by the output union: stored once.  Parts share no sku and period, so each is rolled up where it lies
        parts = [(f"positive#{k}", df) for k, df in enumerate(self.positive_parts)] + [(f"negative#{k}", df) for k, df in enumerate(self.negative_parts)]
        return stored(allocate.union_all([allocate.allocated_rollup(self._watch(df, name, cost="cogs_manufacturing", share="cost_share"))
                                          for name, df in parts]))

    # --- reporting system and reconciliation ---------------------------------
    @functools.cached_property
    def reporting_extracts(self) -> DataFrame:  # stage 21 (before the pivot)
        return reporting.account_extracts(self.i.reporting_facts, self.i.account_hier, self.i.entity_hier, self.p, self.reporting_tasks)

    @functools.cached_property
    def reporting_wide(self) -> DataFrame:  # stage 21
        return reporting.reporting_wide(self.reporting_extracts, self.reporting_tasks)

    @functools.cached_property
    def reporting_measures(self) -> DataFrame:  # stage 22
        return reporting.reporting_measures(self.reporting_wide)

    @functools.cached_property
    def reconcile_delta(self) -> DataFrame:  # stage 23
        if self.figures is None:
            return reconcile.reconcile_delta(self.reporting_measures, self.actuals_customer)
        money = sum(F.coalesce(F.col(m), F.lit(0)) for m in reconcile.DELTA_MEASURES if m != "volume")
        return reconcile.reconcile_delta(self._watch(self.reporting_measures, "reported", reported=money), self.actuals_customer, self._watch)

    @functools.cached_property
    def exchange_rates(self) -> DataFrame:  # stages 24-27
        return stored(fx.exchange_rates(self.i.fx_rates, self.p))

    @functools.cached_property
    def pnl_union(self) -> DataFrame:  # stage 28
        return reconcile.pnl_union(self.reconcile_delta, self.actuals_customer)

    @functools.cached_property
    def pnl_long(self) -> DataFrame:  # stage 30
        return output.pnl_long(self.pnl_union, self.union_tasks)

    @functools.cached_property
    def pnl_fx(self) -> DataFrame:  # stages 30-31: converted in wide form, then one row per account
        rows = output.by_conversion(self.pnl_union, self.union_tasks).withColumnsRenamed({m: m.upper() for m in output.WIDE_MEASURES})
        return fx.convert_wide(rows, self.exchange_rates, output.FX_KEYS, list(rules.ACTUAL_MEASURES))

    @functools.cached_property
    def actuals_final(self) -> DataFrame:  # stage 32
        return output.actuals_final(self.pnl_fx, self.i.country_clusters, self.p, unique=True)

    # --- planning ------------------------------------------------------------
    @functools.cached_property
    def planning_base(self) -> DataFrame:  # stage 33
        return planning.planning_base(self.i.planning_facts, self.p)

    @functools.cached_property
    def planning_enriched(self) -> DataFrame:  # stage 34
        return planning.planning_enriched(self.planning_base, self.i.product_hier, self.i.brand_hier,
                                          self.i.planning_accounts, self.i.country_clusters)

    @functools.cached_property
    def planning_net_revenue(self) -> DataFrame:  # stage 35
        return planning.planning_net_revenue(self.planning_enriched)

    @functools.cached_property
    def planning_union(self) -> DataFrame:  # stage 36
        return self.planning_enriched.unionByName(self.planning_net_revenue)

    @functools.cached_property
    def planning_final(self) -> DataFrame:  # stage 37
        return output.planning_final(self.planning_union)

    # --- result --------------------------------------------------------------
    @functools.cached_property
    def result(self) -> DataFrame:  # stage 38
        return output.final_union(self.actuals_final, self.planning_final)


def full_pnl(inputs: Inputs, params: JobParams, figures: Figures | None = None) -> DataFrame:
    """The 22-column customer P&L table.  ``figures`` takes the conservation sums of the run."""
    return Stages(inputs, params, figures).result
