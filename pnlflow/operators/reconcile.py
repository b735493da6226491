"""Reconciliation of the reporting system against the allocated ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.operators.accounts import evaluate, job_formulas

DELTA_MEASURES = ["cogs_manufacturing", "cogs_logistic", "gross_sales", "g2n", "volume"]
LEDGER_ATTRS = ["currency_copa", "bsp", "brand", "category", "ff"]


def ledger_summary(actuals: DataFrame) -> DataFrame:
    """Allocated ledger per (currency, period, sku, product attributes)."""
    return (actuals.groupBy("currency_copa", "period_year", "sku", "bsp", "brand", "category", "ff")
            .agg(F.sum("cost_share").alias("cogs_manufacturing"),
                 F.sum("cogs_logistic").alias("cogs_logistic"),
                 F.sum("gross_sales").alias("gross_sales"),
                 F.sum("g2n").alias("g2n"),
                 F.sum("volume_net").alias("volume")))


def join_ledger(reporting: DataFrame, actuals: DataFrame) -> DataFrame:
    """Reporting rows with the ledger summary of their (sku, period), its measures as __l_*."""
    ledger = ledger_summary(actuals).select(
        "sku", "period_year", *LEDGER_ATTRS, *[F.col(m).alias(f"__l_{m}") for m in DELTA_MEASURES])
    return reporting.select("sku", "period_year", "country", *DELTA_MEASURES).join(ledger, ["sku", "period_year"], "left")


def reconcile_delta(reporting: DataFrame, actuals: DataFrame, watch: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Reporting minus ledger per reporting key (sku, period, country) and ledger
    attribute combination; NULL -> 0 on both sides.

    Left join from the reporting side on (sku, period) only: keys only in the
    ledger give no delta, and a key with several ledger attribute combinations
    repeats the full reporting amount for each.  The reporting side has one row
    per (sku, period, country) and the ledger summary one per attribute
    combination, so every output group holds exactly one joined row and the
    difference of sums is a difference of values (no extra aggregation)."""
    joined = join_ledger(reporting, actuals)
    difference = {m: S.zero_if_null(m) - S.zero_if_null(f"__l_{m}") for m in DELTA_MEASURES}
    if watch is not None:  # sums of all money measures: reported, ledger, delta
        money = [m for m in DELTA_MEASURES if m != "volume"]
        joined = watch(joined, "delta", reported=sum(S.zero_if_null(m) for m in money), ledger=sum(S.zero_if_null(f"__l_{m}") for m in money),
                       delta=sum(difference[m] for m in money))
    return joined.select("period_year", "sku", "country", *LEDGER_ATTRS, *[c.alias(m) for m, c in difference.items()])


def pnl_union(delta: DataFrame, actuals: DataFrame) -> DataFrame:
    """U4 + D7: delta rows booked on the dummy customer / channel, plus the customer rows,
    with net revenue and gross profit derived (a missing part makes them NULL; a delta has none)."""
    dummy = {c: F.lit(rules.DUMMY_KEY) for c in ("customer", "customer_name", "channel", "subchannel")}
    lines = delta.withColumns(dummy).unionByName(
        actuals.drop("cogs_manufacturing").withColumnsRenamed({"cost_share": "cogs_manufacturing", "volume_net": "volume"}))
    made = evaluate(job_formulas("null", shown=True, lower=True), {c: F.col(c) for c in ("gross_sales", "g2n", "cogs_manufacturing", "cogs_logistic")})
    return lines.withColumns(made)
