"""Ledger stages: line filter, base rollup (A1) and key conforming rollup (A2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.rules import JobParams
from pnlflow.sources.layout import in_window

COST_MAN = [f"cost_man_{i}" for i in range(1, 9)]
COST_LOG = [f"cost_log_{i}" for i in range(1, 5)]
BASE_KEYS = ["fiscper", "comp_code", "sku", "customer", "doc_number", "currency_copa"]
CONFORMED_KEYS = ["country", "customer", "period_year", "sku", "sales_order", "currency_copa"]
MEASURES = ["cogs_logistic", "cogs_manufacturing", "g2n", "gross_sales", "volume_net"]


# --- filters (F1, F3-F7) ----------------------------------------------------

def in_period(c: str, p: JobParams) -> Column:
    """inclusive date range."""
    return F.col(c).between(F.lit(p.period_start), F.lit(p.period_end))


def currency_rule(p: JobParams) -> Column:
    """USD companies must book in USD, all others must not.  The company is
    fixed by the run, so the IF collapses to one pushable comparison."""
    if p.company in rules.USD_COMPANIES:
        return F.col("currency") == F.lit(rules.USD)
    return F.col("currency") != F.lit(rules.USD)


def currency_rule_by_row() -> Column:
    """F3 in its general form: the company of each row decides the currency test."""
    return (F.when(F.col("comp_code").isin(*rules.USD_COMPANIES), F.col("currency") == F.lit(rules.USD))
            .otherwise(F.col("currency") != F.lit(rules.USD)))


def indicator_a_allowed() -> Column:
    """NOT IN list (a NULL indicator drops the row)."""
    return ~F.col("indicator_a").isin(*rules.EXCLUDED_INDICATOR_A)


def indicator_b_allowed() -> Column:
    """NULL or equal."""
    return F.col("indicator_b").isNull() | (F.col("indicator_b") == F.lit(rules.ALLOWED_INDICATOR_B))


def customer_not_excluded(p: JobParams) -> Column:
    """exclude one key but keep NULLs."""
    return (F.col("customer") != F.lit(p.excluded_customer)) | F.col("customer").isNull()


def ledger_predicate(p: JobParams) -> Column:
    return (in_period("pstng_date", p)
            & currency_rule(p)
            & indicator_a_allowed()
            & indicator_b_allowed()
            & (F.col("comp_code") == F.lit(p.company))
            & customer_not_excluded(p))


# --- A1 ----------------------------------------------------------------------

def _scaled(c: str, p: JobParams) -> Column:
    return F.lit(100) * F.col(c) if p.company in rules.SCALED_COMPANIES else F.col(c)


def _gross(p: JobParams) -> Column:
    g = F.col("gross")
    if p.company in rules.SCALED_COMPANIES:
        return F.lit(100) * g
    if p.company in rules.INDICATOR_COMPANIES:
        return F.when(F.col("indicator_a") == rules.INDICATOR_GROSS_AS_ALLOWANCE, F.lit(0)).otherwise(g)
    return g


def _allowance_returns(p: JobParams) -> Column:
    a, r, g = F.col("allowance"), F.col("returns"), F.col("gross")
    if p.company in rules.SCALED_COMPANIES:
        return F.lit(100) * a + r  # only the first term is scaled
    if p.company in rules.INDICATOR_COMPANIES:
        return F.when(F.col("indicator_a") == rules.INDICATOR_GROSS_AS_ALLOWANCE, g + r).otherwise(a + r)
    return a + r


def company_currency(p: JobParams) -> Column:
    """Currency of the row's company.  Under the company filter only the run's
    company is left, so one branch suffices.  It stays a row expression on
    purpose: a literal would be folded into every later grouping key, and the
    later rollups could then no longer reuse the shuffle of the conforming
    rollup (their keys contain its keys)."""
    return F.when(F.col("comp_code") == F.lit(p.company), F.lit(p.company_currency).cast("string"))


def ledger_base(lines: DataFrame, p: JobParams) -> DataFrame:
    """A1: filter the ledger and roll it up to (period, company, sku, customer,
    order, currency).  The company is a run parameter, so its rule branches are
    resolved here and every measure stays a plain SUM (partial aggregation
    before the shuffle)."""
    return (in_window(lines, p.period_start, p.period_end).where(ledger_predicate(p))
            .select("fiscper", "comp_code", S.strip_zeros_trim("material").alias("sku"), "customer",
                    "doc_number", company_currency(p).alias("currency_copa"),
                    "volume", _gross(p).alias("gross"),
                    *[_scaled(c, p).alias(c) for c in ("trade_incentive", "consumer_incentive",
                                                        "other_deduction", "npd")],
                    _allowance_returns(p).alias("allowance_returns"),
                    *COST_MAN, *COST_LOG)
            .groupBy(*BASE_KEYS)
            .agg(F.sum("volume").alias("volume"),
                 F.sum("gross").alias("gross_sales"),
                 F.sum("trade_incentive").alias("trade_incentives"),
                 F.sum("consumer_incentive").alias("consumer_incentives"),
                 F.sum("other_deduction").alias("other_deductions"),
                 F.sum("allowance_returns").alias("sales_allow_returns"),
                 F.sum("npd").alias("npd"),
                 # sum of per-column sums: NULL as soon as one column is all NULL in the group
                 sum_of_sums(COST_MAN).alias("cogs_manufacturing"),
                 sum_of_sums(COST_LOG).alias("cogs_logistic")))


def sum_of_sums(cols: list[str]) -> Column:
    out = None
    for c in cols:
        out = F.sum(c) if out is None else out + F.sum(c)
    return out


# --- A2 ----------------------------------------------------------------------

def conformed_keys(p: JobParams) -> list[Column]:
    """Country from the raw customer, customer and SKU defaults and re-keying."""
    stripped = S.strip_zeros_regex("customer")
    country = (F.when(stripped.isin(*p.country_customers), F.lit(rules.COUNTRY_IN_SET))
               .otherwise(F.lit(rules.COUNTRY_DEFAULT)))
    customer = (F.when(F.col("customer").isNull(), F.lit(p.default_customer))
                .when(F.col("sku").isin(*p.rekey_skus) & F.col("customer").isin(p.default_customer),
                      F.lit(p.rekey_customer))
                .otherwise(stripped))
    sku = F.when(F.col("sku").isNull(), F.lit(p.default_sku)).otherwise(S.prefixed(rules.SKU_PREFIX, "sku"))
    return [country.alias("country"), customer.alias("customer"), F.col("fiscper").alias("period_year"),
            sku.alias("sku"), F.col("doc_number").alias("sales_order"), F.col("currency_copa")]


def conform(base: DataFrame, p: JobParams) -> DataFrame:
    """A2: re-aggregate after key cleaning; G2N is a sum of four sums."""
    return (base.select(*conformed_keys(p), "cogs_logistic", "cogs_manufacturing", "trade_incentives",
                        "other_deductions", "sales_allow_returns", "npd", "gross_sales", "volume")
            .groupBy(*CONFORMED_KEYS)
            .agg(F.sum("cogs_logistic").alias("cogs_logistic"),
                 F.sum("cogs_manufacturing").alias("cogs_manufacturing"),
                 sum_of_sums(["trade_incentives", "other_deductions", "sales_allow_returns", "npd"]).alias("g2n"),
                 F.sum("gross_sales").alias("gross_sales"),
                 F.sum("volume").alias("volume_net")))
