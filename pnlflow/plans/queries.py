"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query runs the job's stages over the whole derived inputs of a scale
directory and returns one stage (or one operator applied to whole tables).
Numeric results are returned as DOUBLE on both sides: sums are exact decimals
up to that last cast, so both engines produce identical values.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.functions.codes import CodeTable
from pnlflow.operators import allocate, enrich, fx, guard, ledger, output, planning, reconcile, reporting, reshape
from pnlflow.operators.accounts import derive_long, job_formulas
from pnlflow.operators.levels import cost_balance, level_check
from pnlflow.plans import oracle as O
from pnlflow.plans.pipeline import CASCADE_LEVELS, SCOPE, SIGN_GROUP, Stages
from pnlflow.rules import JobParams, synthetic_params
from pnlflow.sources.inputs import derived_inputs

ROW_DIMS = ["sku", "country", "customer", "customer_name", "channel", "subchannel", "period_year", "sales_order",
            "currency_copa", "category", "bsp", "brand", "ff"]
M5 = ["cogs_logistic", "cogs_manufacturing", "g2n", "gross_sales", "volume_net"]


@dataclasses.dataclass(frozen=True)
class Query:
    name: str
    spark: Callable[[Stages], DataFrame]
    oracle: str | None  # final SELECT over the oracle stages; None = no SQL oracle
    cols: tuple[str, ...]  # output columns (same names on both sides)
    nums: tuple[str, ...] = ()  # numeric output columns (cast to DOUBLE)


REGISTRY: dict[str, Query] = {}


def reg(name: str, spark: Callable[[Stages], DataFrame], oracle_from: str | None, cols: Sequence[str],
        nums: Sequence[str] = (), oracle_where: str = "") -> None:
    """Register a query whose oracle is ``SELECT cols FROM oracle_from [oracle_where]``."""
    REGISTRY[name] = Query(name, spark, None if oracle_from is None else f"FROM {oracle_from} {oracle_where}",
                           tuple(cols), tuple(nums))


# Date columns of query results.  At the query boundary they are handed over as
# midnight TIMESTAMP_NTZ on both sides (the type of the test tables' own date
# columns), so both engines give the same pandas type to the value comparison.
DATE_COLS = frozenset({"pstng_date", "date", "DATE", "period_date"})


def _final_select(qy: Query) -> str:
    def expr(c: str) -> str:
        if c in qy.nums:
            return f'CAST("{c}" AS DOUBLE) AS "{c}"'
        if c in DATE_COLS:
            return f'CAST("{c}" AS TIMESTAMP) AS "{c}"'
        return f'"{c}"'
    return f"SELECT {', '.join(expr(c) for c in qy.cols)}\n{qy.oracle}"


def as_output(df: DataFrame, cols: Sequence[str], nums: Sequence[str]) -> DataFrame:
    out = []
    for c in cols:
        dtype = df.schema[c].dataType
        if c in nums or isinstance(dtype, T.DecimalType):
            out.append(F.col(c).cast("double").alias(c))
        elif isinstance(dtype, T.DateType):
            if c not in DATE_COLS:
                raise ValueError(f"date column {c} missing from DATE_COLS")
            out.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ----------------------------------------------------------------------------
# S, F: scans and filters over whole tables
# ----------------------------------------------------------------------------
P = synthetic_params()
LEDGER_SCAN = ["fiscper", "comp_code", "material", "customer", "doc_number", "pstng_date", "currency", "volume",
               "gross"]


def _ledger(st: Stages, cond) -> DataFrame:
    return st.i.ledger_lines.where(cond)


def _sql_ledger_filter(p: JobParams) -> str:
    return (f"WHERE pstng_date BETWEEN {O.d(p.period_start)} AND {O.d(p.period_end)} "
            f"AND currency <> 'USD' AND indicator_a NOT IN ('IC') "
            f"AND (indicator_b IS NULL OR indicator_b = 'ES') AND comp_code = {O.q(p.company)} "
            f"AND (customer <> {O.q(p.excluded_customer)} OR customer IS NULL)")


reg("s02_ledger_scan", lambda st: _ledger(st, ledger.ledger_predicate(st.p)), "ledger_lines",
    LEDGER_SCAN, ["volume", "gross"], _sql_ledger_filter(P))
reg("f01_period_between", lambda st: _ledger(st, ledger.in_period("pstng_date", st.p)), "ledger_lines",
    LEDGER_SCAN, ["volume", "gross"], f"WHERE pstng_date BETWEEN {O.d(P.period_start)} AND {O.d(P.period_end)}")
reg("f02_after_start", lambda st: reporting.reporting_scope(st.i.reporting_facts, st.p), "reporting_facts",
    ["entity", "date", "sku", "currency", "account_code", "value"], ["value"],
    f"WHERE entity = {O.q(P.entity)} AND currency = 'LCL' AND date > {O.d(P.reporting_start)}")
reg("f03_conditional_currency", lambda st: _ledger(st, ledger.currency_rule_by_row()), "ledger_lines",
    LEDGER_SCAN, ["volume", "gross"],
    f"WHERE CASE WHEN comp_code IN {O.in_list(rules.USD_COMPANIES)} THEN currency = 'USD' ELSE currency <> 'USD' END")
reg("f04_not_in", lambda st: _ledger(st, ledger.indicator_a_allowed()), "ledger_lines",
    LEDGER_SCAN + ["indicator_a"], ["volume", "gross"], "WHERE indicator_a NOT IN ('IC')")
reg("f05_null_or_equal", lambda st: _ledger(st, ledger.indicator_b_allowed()), "ledger_lines",
    LEDGER_SCAN + ["indicator_b"], ["volume", "gross"], "WHERE indicator_b IS NULL OR indicator_b = 'ES'")
reg("f06_exclude_keep_null", lambda st: _ledger(st, ledger.customer_not_excluded(st.p)), "ledger_lines",
    LEDGER_SCAN, ["volume", "gross"], f"WHERE customer <> {O.q(P.excluded_customer)} OR customer IS NULL")
reg("f08_in_list",
    lambda st: st.i.customer_flat.where(F.col("level2").isin(*rules.CHANNEL_BY_LEVEL2)),
    "customer_flat", ["area_id", "sales_org", "hierarchy_type", "level2", "level5"], [],
    f"WHERE level2 IN {O.in_list(rules.CHANNEL_BY_LEVEL2)}")

# ----------------------------------------------------------------------------
# A: aggregations
# ----------------------------------------------------------------------------
BASE_COLS = ["fiscper", "comp_code", "sku", "customer", "doc_number", "currency_copa", "volume", "gross_sales",
             "trade_incentives", "consumer_incentives", "other_deductions", "sales_allow_returns", "npd",
             "cogs_manufacturing", "cogs_logistic"]
reg("a01_ledger_base", lambda st: st.ledger_base, "o_base", BASE_COLS, BASE_COLS[6:])


def _company(code: str) -> None:
    """A1 under another company's rules: all ledger lines, booked to that company."""
    params = dataclasses.replace(P, company=code)
    lines = f"(SELECT * REPLACE ({O.q(code)} AS comp_code) FROM ledger_lines) lines"
    reg(f"a01_ledger_base_{code.lower()}",
        lambda st: ledger.ledger_base(st.i.ledger_lines.withColumn("comp_code", F.lit(code)), params),
        f"({O.base_sql(params, lines)}) t", BASE_COLS, BASE_COLS[6:])


_company(rules.SCALED_COMPANIES[0])
_company(rules.INDICATOR_COMPANIES[0])
_company(rules.USD_COMPANIES[1])
CONF_COLS = ["country", "customer", "period_year", "sku", "sales_order", "currency_copa", *M5]
reg("a02_conformed_rollup", lambda st: st.ledger_conformed, "o_conf", CONF_COLS, M5)
reg("a05_dedupe_max", lambda st: st.ledger_product_customer, "o_lpc", ROW_DIMS + M5, M5)
ACT_COLS = allocate.ROLLUP_DIMS + ["cogs_manufacturing", "cogs_logistic", "g2n", "gross_sales", "volume_net",
                                   "cost_share"]
ACT_NUMS = ACT_COLS[12:]
reg("a08_allocated_rollup", lambda st: st.actuals_customer, "o_actuals", ACT_COLS, ACT_NUMS)
reg("f10_having_any_nonzero", lambda st: allocate.allocated_rollup(st.negative_allocated),
    f"({O.rollup_sql('o_neg_alloc')}) t", ACT_COLS, ACT_NUMS)
EXT_COLS = ["entity", "period_year", "account", "sku", "value"]
reg("a10_reporting_accounts", lambda st: st.reporting_extracts, "o_extracts", EXT_COLS, ["value"])
REP_COLS = ["sku", "period_year", "country", "cogs_manufacturing", "cogs_logistic", "gross_sales", "g2n", "volume",
            "net_revenue", "gross_profit"]
reg("a11_reporting_measures", lambda st: st.reporting_measures, "o_rep_measures", REP_COLS, REP_COLS[3:])


reg("a14_rate_conditional_max", lambda st: fx.current_rates(fx.rate_base(st.i.fx_rates)), "o_rate_current",
    ["year", "date", "period", "version", "currency", "scenario", "ACRate", "ActRate"], ["ACRate", "ActRate"])
FINAL_NUMS = ["Value_AC_Rate", "Value_PY_Rate", "Value_USD", "Value_LCL"]
reg("a18_actuals_final", lambda st: st.actuals_final, "o_actuals_final", rules.OUTPUT_COLUMNS, FINAL_NUMS)
PB_COLS = planning.BASE_KEYS + planning.VALUES
reg("a19_planning_base", lambda st: st.planning_base, "o_plan_base", PB_COLS, planning.VALUES)
reg("a20_any_value_rollup", lambda st: planning.product_rollup(st.i.product_hier, st.i.brand_hier),
    "o_plan_products", ["category", "brand", "bws", "subbrand", "format_flavor", "sku"])
reg("a21_distinct",
    lambda st: st.customer_dim.select("customer", "customer_name", "channel", "subchannel").distinct(),
    "(SELECT DISTINCT customer, customer_name, channel, subchannel FROM o_cust) t",
    ["customer", "customer_name", "channel", "subchannel"])
PE_COLS = planning.ENRICHED_KEYS + planning.VALUES
reg("a22_planning_enriched", lambda st: st.planning_enriched, "o_plan", PE_COLS, planning.VALUES)

# ----------------------------------------------------------------------------
# J: joins
# ----------------------------------------------------------------------------
reg("j01_product_brand_left", lambda st: st.product_dim, "o_prod", ["sku", "category", "brand", "bsp", "ff"])
reg("j02_customer_chain", lambda st: st.customer_dim, "o_cust",
    ["bu", "channel", "subchannel", "customer", "customer_name"])
LP_COLS = enrich.LEDGER_PRODUCT_KEYS + M5
reg("j03_ledger_product_inner", lambda st: st.ledger_product, "o_lp", LP_COLS, M5)
ORPH_COLS = ["period_year", "sku", *M5]
reg("j04_orphan_sku_anti", lambda st: st.orphan_sku, "o_orphan_sku", ORPH_COLS, M5)
reg("j05_customer_left_distinct", lambda st: enrich.join_customer_attributes(st.ledger_product, st.customer_dim),
    "o_lp a LEFT JOIN (SELECT DISTINCT customer, customer_name, channel, subchannel FROM o_cust) b "
    "USING (customer)", ROW_DIMS + M5, M5)
reg("j06_orphan_customer_anti", lambda st: st.orphan_customer, "o_orphan_customer", ORPH_COLS, M5)
reg("j07_attach_pool_inner",
    lambda st: allocate.attach_per_period(st.ledger_product_customer, st.orphan_pool, "period_year"),
    "(SELECT r.*, p.pool_cost FROM o_lpc r JOIN o_period p USING (period_year)) t", ROW_DIMS + M5 + ["pool_cost"], M5 + ["pool_cost"])
def _j08(st: Stages) -> DataFrame:
    with_pool = allocate.attach_per_period(st.ledger_product_customer, st.orphan_pool, "period_year")
    total = allocate.period_total(with_pool, "period_year", "volume_net", "period_volume")
    return allocate.attach_per_period(with_pool, total, "period_year")


reg("j08_self_total", _j08,
    "o_lpc JOIN o_period USING (period_year)",
    ROW_DIMS + M5 + ["pool_cost", "period_volume"], M5 + ["pool_cost", "period_volume"])


def _j09(st: Stages) -> DataFrame:
    return reporting.join_accounts(reporting.reporting_scope(st.i.reporting_facts, st.p),
                                   reporting.extract_map(st.i.account_hier, st.i.entity_hier, st.p))


_J09_SCOPE = f"fd.entity = {O.q(P.entity)} AND fd.currency = 'LCL' AND fd.date > {O.d(P.reporting_start)}"
reg("j09_fact_account_entity", _j09,
    "(" + " UNION ALL ".join(
        f"SELECT fd.entity, date, sku, account_code, {n} AS extract, level_0{n} AS account, value FROM reporting_facts fd "
        f"JOIN account_hier fa USING (account_code) JOIN entity_hier fe ON fd.entity = fe.entity "
        f"WHERE {_J09_SCOPE} AND level_0{n} IN {O.in_list(codes)}"
        for n, codes in ((8, rules.REPORTING_LEVEL_08), (7, rules.REPORTING_LEVEL_07)))
    + f" UNION ALL SELECT fd.entity, date, sku, account_code, 0, account_code, value FROM reporting_facts fd "
      f"WHERE {_J09_SCOPE} AND account_code IN {O.in_list(rules.REPORTING_LEAF)}) t",
    ["entity", "date", "sku", "account_code", "extract", "account", "value"], ["value"])


def _j10(st: Stages) -> DataFrame:
    return reconcile.join_ledger(st.reporting_measures, st.actuals_customer).withColumnsRenamed(
        {"gross_sales": "reporting_gross_sales", "volume": "reporting_volume", "__l_gross_sales": "ledger_gross_sales",
         "__l_volume": "ledger_volume"})


J10_COLS = ["sku", "period_year", "country", "currency_copa", "bsp", "brand", "category", "ff",
            "reporting_gross_sales", "reporting_volume", "ledger_gross_sales", "ledger_volume"]
reg("j10_reconcile_left", _j10,
    "(SELECT b.sku, b.period_year, b.country, a.currency_copa, a.bsp, a.brand, a.category, a.ff, "
    "b.gross_sales AS reporting_gross_sales, b.volume AS reporting_volume, a.gross_sales AS ledger_gross_sales, "
    "a.volume AS ledger_volume FROM o_rep_measures b LEFT JOIN o_ledger_summary a "
    "ON b.sku = a.sku AND b.period_year = a.period_year) t", J10_COLS, J10_COLS[8:])
RATE_COLS = ["fiscper", "currency", "ACRate", "ActRate", "ACPYRate", "ActPYRate"]
reg("j11_prior_year_rate", lambda st: st.exchange_rates, "o_rates", RATE_COLS, RATE_COLS[2:])


LONG_COLS = output.LONG_KEYS + ["account", "amount"]
reg("j12_fx_lookup", lambda st: fx.attach_rates(st.pnl_long, st.exchange_rates),
    "o_long a LEFT JOIN o_rates b ON a.currency_copa = b.currency AND a.period_year = b.fiscper",
    LONG_COLS + ["ActRate", "ACRate", "ActPYRate"], ["amount", "ActRate", "ACRate", "ActPYRate"])
FX_COLS = output.FX_KEYS + ["account", "amount_lcl", "amount_usd", "value_ac_rate", "value_py_rate"]


reg("j13_cluster_lookup",
    lambda st: planning.attach_clusters(st.pnl_fx, planning.cluster_lookup(st.i.country_clusters, st.p.entity)),
    f"o_fx a LEFT JOIN (SELECT upper(country) AS country_key, cluster1, cluster2 FROM country_clusters "
    f"WHERE fit_entity = {O.q(P.entity)}) b ON a.country = b.country_key",
    FX_COLS + ["cluster1", "cluster2"], FX_COLS[-4:])


J14_COLS = ["date", "account", "product", "channel", "value_lcl", "value_usd", "category", "brand", "subbrand",
            "format_flavor", "sku"]
reg("j14_planning_product",
    lambda st: planning.attach_products(st.planning_base, planning.product_rollup(st.i.product_hier, st.i.brand_hier)),
    "o_plan_base fd LEFT JOIN o_plan_products ph ON fd.product = ph.bws",
    J14_COLS, planning.VALUES)


J15_COLS = ["date", "account", "product", "channel", "level_account", "value_lcl", "value_usd"]
reg("j15_planning_accounts",
    lambda st: planning.attach_accounts(st.planning_base, planning.account_map(st.i.planning_accounts)),
    "o_plan_base fd JOIN (SELECT account_code, account AS level_account FROM o_plan_accounts) am "
    "ON fd.account = am.account_code", J15_COLS, planning.VALUES)


J16_COLS = ["date", "account", "product", "country", "country_key", "cluster1", "cluster2", "value_lcl"]
reg("j16_planning_cluster",
    lambda st: planning.attach_clusters(planning.with_country(st.planning_base), planning.cluster_lookup(st.i.country_clusters)),
    f"(SELECT *, {O.case_map('entity', rules.PLANNING_ENTITY_COUNTRY)} AS country FROM o_plan_base) fd "
    "LEFT JOIN (SELECT upper(country) AS country_key, cluster1, cluster2 FROM country_clusters) ch "
    "ON fd.country = ch.country_key", J16_COLS, ["value_lcl"])

# ----------------------------------------------------------------------------
# W: group totals per row (windows in the oracle, aggregate + join in Spark)
# ----------------------------------------------------------------------------
reg("w01_volume_sign", lambda st: st.sign_table.rows,
    "o_flagged", ROW_DIMS + ["volume_net", "flag"], ["volume_net"])


def _positive(st: Stages) -> list[DataFrame]:
    return [df for df, _ in st.sign_table.positive]


def _level_cols(st: Stages, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    df = allocate.attach_level_totals(_positive(st), CASCADE_LEVELS, SCOPE, "volume_net", "cogs_manufacturing",
                                      cols)
    return df.select(*ROW_DIMS, "volume_net", *[F.col(c).alias(n) for c, n in zip(cols, names)])


VOL_NAMES = ["vol_sku", "vol_ff", "vol_bsp", "vol_category", "vol_scope"]
reg("w02_volume_levels",
    lambda st: _level_cols(st, ["__vol_0", "__vol_1", "__vol_2", "__vol_3", "__vol_scope"], VOL_NAMES),
    "o_pos_totals", ROW_DIMS + ["volume_net", *VOL_NAMES], ["volume_net", *VOL_NAMES])
reg("w03_cost_levels", lambda st: _level_cols(st, ["__cost_0"], ["cm_sku"]),
    "o_pos_totals", ROW_DIMS + ["volume_net", "cm_sku"], ["volume_net", "cm_sku"])
PASS_NAMES = ["passed_ff", "passed_bsp", "passed_category", "passed_scope"]
reg("w04_passed_up",
    lambda st: _level_cols(st, ["__passed_1", "__passed_2", "__passed_3", "__passed_4"], PASS_NAMES),
    "o_pos_passed", ROW_DIMS + ["volume_net", *PASS_NAMES], ["volume_net", *PASS_NAMES])


reg("w05_negative_totals",
    lambda st: allocate.union_all([allocate.with_group_totals(df, ["sku", *SCOPE], {"volume_net": "vol_sku", "cogs_manufacturing": "cm_sku"}, bounded)
                                   for df, bounded in st.sign_table.negative]),
    "(SELECT *, SUM(volume_net) OVER (PARTITION BY sku, country, period_year) AS vol_sku, "
    "SUM(cogs_manufacturing) OVER (PARTITION BY sku, country, period_year) AS cm_sku "
    "FROM o_flagged WHERE flag = 'negative') t", ROW_DIMS + ["volume_net", "vol_sku", "cm_sku"],
    ["volume_net", "vol_sku", "cm_sku"])

# ----------------------------------------------------------------------------
# R: reshape
# ----------------------------------------------------------------------------
WIDE_COLS = ["period_year", "country", "sku", *reporting.REPORTING_MEASURES]
reg("r01_pivot_accounts", lambda st: st.reporting_wide, "o_rep_wide", WIDE_COLS, WIDE_COLS[3:])
reg("r02_unpivot_measures", lambda st: st.pnl_long, "o_long", LONG_COLS, ["amount"])
PLAN_LABELS = ["COGS_MANUFACTURING", "COGS_LOGISTIC", "GROSS_SALES", "G2N", "GROSS_PROFIT", "VOLUME"]
PLAN_KEYS11 = [k for k in planning.ENRICHED_KEYS if k != "cuenta"]
R03_VALS = [f"{c}_{v}" for c in PLAN_LABELS for v in ("usd", "lcl")]


reg("r03_pivot_two_measures",
    lambda st: reshape.pivot_sums(st.planning_enriched, PLAN_KEYS11, "cuenta", {"value_usd": "usd", "value_lcl": "lcl"},
                                  PLAN_LABELS),
    "(SELECT " + ", ".join(PLAN_KEYS11) + ", " + ", ".join(
        f"SUM(CASE WHEN cuenta = '{c}' THEN value_{v} END) AS {c}_{v}" for c in PLAN_LABELS for v in ("usd", "lcl"))
    + " FROM o_plan GROUP BY " + ", ".join(PLAN_KEYS11) + ") t", PLAN_KEYS11 + R03_VALS, R03_VALS)

# ----------------------------------------------------------------------------
# C: scalar functions over whole tables
# ----------------------------------------------------------------------------
reg("c01_strip_zeros",
    lambda st: st.i.ledger_lines.select("material", S.strip_zeros_trim("material").alias("stripped")),
    "(SELECT material, ltrim(material, '0') AS stripped FROM ledger_lines) t", ["material", "stripped"])
reg("c02_regex_strip",
    lambda st: st.i.ledger_lines.select("customer", S.strip_zeros_regex("customer").alias("stripped")),
    "(SELECT customer, regexp_replace(customer, '^0+', '') AS stripped FROM ledger_lines) t",
    ["customer", "stripped"])


def _c03(st: Stages) -> DataFrame:
    return st.reporting_extracts.select(
        "entity", S.label("entity", rules.ENTITY_COUNTRY).alias("country"), "account",
        S.label("account", rules.ACCOUNT_MEASURE).alias("measure"), "sku", "value")


reg("c03_code_labels", _c03,
    f"(SELECT entity, {O.case_groups('entity', rules.ENTITY_COUNTRY)} AS country, account, "
    f"{O.case_map('account', rules.ACCOUNT_MEASURE)} AS measure, sku, value FROM o_extracts) t",
    ["entity", "country", "account", "measure", "sku", "value"], ["value"])


# every code of every label table (and one unknown code), dealt over the ledger lines
CODE_TABLES = {
    "company": (rules.COMPANY_CURRENCY, S.label, O.case_map), "entity": (rules.ENTITY_COUNTRY, S.label, O.case_groups),
    "level2": (rules.CHANNEL_BY_LEVEL2, S.label, O.case_map), "account": (rules.ACCOUNT_MEASURE, S.label, O.case_map),
    "planning_account": (rules.PLANNING_ACCOUNT_MEASURE, S.label, O.case_map),
    "planning_entity": (rules.PLANNING_ENTITY_COUNTRY, S.label, O.case_map),
    **{f"measure_{k}": ({m: x[k - 1] for m, x in rules.ACCOUNT_LABELS.items()}, S.label, O.case_map) for k in (1, 2, 3)},
}


def _c03_all(st: Stages) -> DataFrame:
    line = F.coalesce(F.col("material").cast("bigint"), F.lit(0))
    coded = st.i.ledger_lines.select("material", "doc_number", *[
        F.element_at(F.array(*map(F.lit, [*t, "?"])), (line % (len(t) + 1) + 1).cast("int")).alias(n) for n, (t, *_) in CODE_TABLES.items()])
    return coded.select("*", *[label(n, t).alias(f"{n}_label") for n, (t, label, _) in CODE_TABLES.items()])


reg("c03_all_code_tables", _c03_all,
    "(SELECT *, " + ", ".join(f"{case(n, t)} AS {n}_label" for n, (t, _, case) in CODE_TABLES.items())
    + " FROM (SELECT material, doc_number, " + ", ".join(
        f"[{', '.join(map(O.q, [*t, '?']))}][COALESCE(CAST(material AS BIGINT), 0) % {len(t) + 1} + 1] AS {n}"
        for n, (t, *_) in CODE_TABLES.items()) + " FROM ledger_lines) coded) t",
    ["material", "doc_number", *CODE_TABLES, *[f"{n}_label" for n in CODE_TABLES]])


def _c04(st: Stages) -> DataFrame:
    keys = ledger.conformed_keys(st.p)
    return st.ledger_base.select(F.col("customer").alias("raw_customer"), F.col("sku").alias("raw_sku"),
                                 keys[0], keys[1], keys[3])


reg("c04_key_defaults", _c04,
    f"""(SELECT customer AS raw_customer, sku AS raw_sku,
    CASE WHEN regexp_replace(customer, '^0+', '') IN {O.in_list(P.country_customers)}
         THEN {O.q(rules.COUNTRY_IN_SET)} ELSE {O.q(rules.COUNTRY_DEFAULT)} END AS country,
    CASE WHEN customer IS NULL THEN {O.q(P.default_customer)}
         WHEN sku IN {O.in_list(P.rekey_skus)} AND customer IN ({O.q(P.default_customer)}) THEN {O.q(P.rekey_customer)}
         ELSE regexp_replace(customer, '^0+', '') END AS customer,
    CASE WHEN sku IS NULL THEN {O.q(P.default_sku)} ELSE 'SK' || sku END AS sku FROM o_base) t""",
    ["raw_customer", "raw_sku", "country", "customer", "sku"])
reg("c05_prefix_key", lambda st: st.ledger_base.select("sku", S.prefixed(rules.SKU_PREFIX, "sku").alias("sku_key")),
    "(SELECT sku, 'SK' || sku AS sku_key FROM o_base) t", ["sku", "sku_key"])
reg("c06_replace_prefix",
    lambda st: st.i.reporting_facts.select(
        "sku", S.replace_text("sku", rules.REPORTING_SKU_PREFIX, rules.SKU_PREFIX).alias("sku_clean")),
    "(SELECT sku, replace(sku, 'SKU_SK', 'SK') AS sku_clean FROM reporting_facts) t", ["sku", "sku_clean"])
reg("c07_fiscal_period",
    lambda st: st.i.reporting_facts.select("date", S.fiscal_period("date").alias("period_year")),
    "(SELECT date, strftime(date, '%Y0%m') AS period_year FROM reporting_facts) t", ["date", "period_year"])
reg("c08_period_to_date",
    lambda st: st.i.ledger_lines.select("fiscper", S.period_to_date("fiscper").alias("period_date")),
    f"(SELECT fiscper, {O.period_date('fiscper')} AS period_date FROM ledger_lines) t",
    ["fiscper", "period_date"])
reg("c09_month_name_date",
    lambda st: st.i.fx_rates.select("year", "period",
                                    S.month_name_date("year", "period", rules.MONTH_ABBREVIATIONS).alias("date")),
    "(SELECT year, period, CAST(strptime(CAST(year AS VARCHAR) || '-' || (CASE period " + " ".join(
        f"WHEN '{m}' THEN '{i:02d}'" for i, m in enumerate(rules.MONTH_ABBREVIATIONS, start=1))
    + " END) || '-01', '%Y-%m-%d') AS DATE) AS date FROM fx_rates) t", ["year", "period", "date"])
reg("c15_safe_divide",
    lambda st: st.ledger_base.select("fiscper", "sku", "customer", "doc_number", "gross_sales", "volume",
                                     S.safe_divide("gross_sales", "volume").alias("price")),
    "(SELECT fiscper, sku, customer, doc_number, gross_sales, volume, "
    f"{O.ratio('gross_sales', 'volume')} AS price FROM o_base) t",
    ["fiscper", "sku", "customer", "doc_number", "gross_sales", "volume", "price"],
    ["gross_sales", "volume", "price"])

# codes without a label, over the whole columns that the tables are applied to
CODE_USES = [("company_currency", rules.COMPANY_CURRENCY, "ledger_lines", "comp_code"), ("account_measure", rules.ACCOUNT_MEASURE, "reporting_facts", "account_code"),
             ("entity_country", rules.ENTITY_COUNTRY, "reporting_facts", "entity"), ("channel", rules.CHANNEL_BY_LEVEL2, "customer_flat", "level2"),
             ("planning_account", rules.PLANNING_ACCOUNT_MEASURE, "planning_facts", "account"),
             ("month", {m: str(k) for k, m in enumerate(rules.MONTH_ABBREVIATIONS, start=1)}, "fx_rates", "period")]
reg("c03_unmapped_codes",
    lambda st: allocate.union_all([CodeTable.of(n, labels.items()).unmapped(getattr(st.i, table), c) for n, labels, table, c in CODE_USES]),
    "(" + " UNION ALL ".join(f"SELECT '{n}' AS code_table, CAST({c} AS VARCHAR) AS code, COUNT(*) AS n_rows FROM {table} WHERE {c} NOT IN {O.in_list(labels)} GROUP BY {c}"
                             for n, labels, table, c in CODE_USES) + ") t", ["code_table", "code", "n_rows"])

# what each dimension does to the rows that join it
FAN_COLS = ["dimension", "fact_rows", "joined_rows", "unmatched_rows", "amount", "joined_amount"]
FAN_OUTS = [  # name, fact, dimension, fact key, dimension key, amount, the same in SQL
    ("product", lambda st: st.ledger_conformed, lambda st: st.product_dim, "sku", "sku", "gross_sales", "o_conf", "o_prod"),
    ("customer", lambda st: st.ledger_product, lambda st: st.customer_dim.select("customer", *enrich.CUSTOMER_ATTRS).distinct(), "customer", "customer",
     "gross_sales", "o_lp", "(SELECT DISTINCT customer, customer_name, channel, subchannel FROM o_cust)"),
    ("cluster_of_entity", lambda st: st.pnl_union, lambda st: planning.cluster_lookup(st.i.country_clusters, st.p.entity), "country", "country_key", "gross_sales",
     "o_union", f"(SELECT upper(country) AS country_key FROM country_clusters WHERE fit_entity = {O.q(P.entity)})"),
    ("cluster", lambda st: planning.with_country(st.planning_base), lambda st: planning.cluster_lookup(st.i.country_clusters), "country", "country_key", "value_lcl",
     f"(SELECT *, {O.case_map('entity', rules.PLANNING_ENTITY_COUNTRY)} AS country FROM o_plan_base)",
     "(SELECT upper(country) AS country_key FROM country_clusters)"),
    ("planning_account", lambda st: st.planning_base, lambda st: planning.account_map(st.i.planning_accounts), "account", "account_code", "value_lcl",
     "o_plan_base", "o_plan_accounts"),
]
reg("j_fan_out", lambda st: allocate.union_all([guard.fan_out(fact(st), dim(st), {f: d}, amount, name) for name, fact, dim, f, d, amount, _, _ in FAN_OUTS]),
    "(" + " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, COUNT(*) AS fact_rows, CAST(SUM(COALESCE(n, 1)) AS BIGINT) AS joined_rows, COUNT(*) - COUNT(n) AS unmatched_rows,
       COALESCE(SUM({amount}), 0) AS amount, COALESCE(SUM({amount} * COALESCE(n, 1)), 0) AS joined_amount
FROM {fact} a LEFT JOIN (SELECT {d} AS k, COUNT(*) AS n FROM {dim} d WHERE {d} IS NOT NULL GROUP BY {d}) c ON a.{f} = c.k"""
                             for name, _, _, f, d, amount, fact, dim in FAN_OUTS) + ") t", FAN_COLS, ["amount", "joined_amount"])
PROFILE_COLS = ["dimension", "dim_rows", "null_keys", "distinct_keys", "repeated_keys", "most_rows"]
PROFILES = [(name, dim, d, sql) for name, _, dim, _, d, _, _, sql in FAN_OUTS] + [
    ("brand", lambda st: st.i.brand_hier, "brand_segment", "brand_hier"), ("product_hierarchy", lambda st: st.i.product_hier, "sku", "product_hier")]
reg("j_key_profile", lambda st: allocate.union_all([guard.key_profile(dim(st), [k]).select(F.lit(name).alias("dimension"), "*") for name, dim, k, _ in PROFILES]),
    "(" + " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS dim_rows, CAST(COALESCE(SUM(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       COUNT(k) AS distinct_keys, COUNT(k) FILTER (WHERE n > 1) AS repeated_keys, COALESCE(MAX(n) FILTER (WHERE k IS NOT NULL), 0) AS most_rows
FROM (SELECT {k} AS k, COUNT(*) AS n FROM {sql} d GROUP BY {k}) g""" for name, _, k, sql in PROFILES) + ") t", PROFILE_COLS)

# ----------------------------------------------------------------------------
# U: unions
# ----------------------------------------------------------------------------
ALLOC_COLS = ROW_DIMS + ["volume_net", "cogs_manufacturing", "cost_share"]
ALLOC_NUMS = ["volume_net", "cogs_manufacturing", "cost_share"]
reg("u02_union_branches",
    lambda st: st.positive_allocated.select(*ALLOC_COLS).unionByName(st.negative_allocated.select(*ALLOC_COLS)),
    "(SELECT " + ", ".join(ALLOC_COLS) + " FROM o_pos_alloc UNION ALL SELECT " + ", ".join(ALLOC_COLS)
    + " FROM o_neg_alloc) t", ALLOC_COLS, ALLOC_NUMS)
UNION_COLS = ["sku", "customer", "customer_name", "country", "currency_copa", "bsp", "brand", "category", "ff",
              "period_year", "channel", "subchannel", "gross_sales", "g2n", "volume", "net_revenue", "gross_profit",
              "cogs_logistic", "cogs_manufacturing"]
reg("u04_union_dummy_keys", lambda st: st.pnl_union, "o_union", UNION_COLS, UNION_COLS[12:])


def _u06(st: Stages) -> DataFrame:
    acct = planning.account_map(st.i.planning_accounts)
    facts = st.i.planning_facts.select(F.col("account").alias("account_code"))
    codes = facts.unionByName(st.i.reporting_facts.select("account_code")).distinct()
    return codes.join(acct, "account_code")


reg("u06_account_map", _u06,
    "(SELECT account AS account_code FROM planning_facts UNION SELECT account_code FROM reporting_facts) c "
    "JOIN o_plan_accounts USING (account_code)",
    ["account_code", "account", "description"])
reg("u08_final_union", lambda st: st.result, "o_result", rules.OUTPUT_COLUMNS, FINAL_NUMS)

# ----------------------------------------------------------------------------
# D: composite operators
# ----------------------------------------------------------------------------
SPREAD_COLS = ROW_DIMS + M5
reg("d01_spread_pool", lambda st: st.pool_spread, "o_spread", SPREAD_COLS, M5)


def _d02(st: Stages) -> DataFrame:
    positive, negative = (allocate.union_all([df for df, _ in parts]) for parts in (st.sign_table.positive, st.sign_table.negative))
    return (positive.select(*SPREAD_COLS, F.lit(allocate.POSITIVE).alias("flag"))
            .unionByName(negative.select(*SPREAD_COLS, F.lit(allocate.NEGATIVE).alias("flag"))))


reg("d02_split_sign", _d02,
    "o_flagged", SPREAD_COLS + ["flag"], M5)
reg("d03_cascade_allocate", lambda st: st.positive_allocated, "o_pos_alloc", ALLOC_COLS, ALLOC_NUMS)


# levels that split, and the cost that is lost or borne twice when they do
def _level_check_sql(levels: Sequence[str]) -> str:
    return "(" + " UNION ALL ".join(f"""
SELECT '{c}' AS child_level, '{p}' AS parent_level, COUNT(*) AS n_groups, COUNT(*) FILTER (WHERE parents > 1) AS split_groups,
       SUM(cost) AS cost, COALESCE(SUM(cost) FILTER (WHERE parents > 1), 0) AS split_cost
FROM (SELECT {c}, country, period_year, COUNT(DISTINCT {p}) + MAX(CASE WHEN {p} IS NULL THEN 1 ELSE 0 END) AS parents, SUM(cogs_manufacturing) AS cost
      FROM o_positive GROUP BY {c}, country, period_year) g""" for c, p in zip(levels, levels[1:])) + ") t"


CHECK_COLS = ["child_level", "parent_level", "n_groups", "split_groups", "cost", "split_cost"]
BALANCE_COLS = [*SCOPE, "n_rows", "cost", "allocated", "unallocated_rows", "lost"]
BALANCE_SQL = """(SELECT country, period_year, COUNT(*) AS n_rows, COALESCE(SUM(cogs_manufacturing), 0) AS cost, COALESCE(SUM(cost_share), 0) AS allocated,
       COUNT(*) - COUNT(cost_share) AS unallocated_rows, COALESCE(SUM(cogs_manufacturing), 0) - COALESCE(SUM(cost_share), 0) AS lost
FROM {} GROUP BY country, period_year) t"""
for _name, _levels in (("d03_level_check", CASCADE_LEVELS), ("d03_level_check_crossed", list(O.CROSSED_LEVELS))):
    reg(_name, lambda st, levels=_levels: level_check(allocate.union_all(_positive(st)), levels, SCOPE, "cogs_manufacturing"),
        _level_check_sql(_levels), CHECK_COLS, ["cost", "split_cost"])
reg("d03_cost_balance", lambda st: cost_balance(st.positive_allocated, SCOPE, "cogs_manufacturing", "cost_share"),
    BALANCE_SQL.format("o_pos_alloc"), BALANCE_COLS, ["cost", "allocated", "lost"])
reg("d03_cost_balance_crossed",
    lambda st: cost_balance(allocate.cascade_allocate(allocate.union_all(_positive(st)), list(O.CROSSED_LEVELS), SCOPE, "volume_net", "cogs_manufacturing",
                                                      "cost_share"), SCOPE, "cogs_manufacturing", "cost_share"),
    BALANCE_SQL.format("x_pos_alloc"), BALANCE_COLS, ["cost", "allocated", "lost"])
reg("d04_prorate_negative", lambda st: st.negative_allocated, "o_neg_alloc", ALLOC_COLS, ALLOC_NUMS)
DELTA_COLS = ["period_year", "sku", "country", "currency_copa", "bsp", "brand", "category", "ff",
              "cogs_manufacturing", "cogs_logistic", "gross_sales", "g2n", "volume"]
reg("d05_reconcile_delta", lambda st: st.reconcile_delta, "o_delta", DELTA_COLS, DELTA_COLS[8:])
reg("d06_convert_fx", lambda st: st.pnl_fx, "o_fx", FX_COLS, FX_COLS[-4:])
reg("d07_derive_pnl",
    lambda st: st.pnl_union.select("sku", "customer", "period_year", "country", "net_revenue", "gross_profit"),
    "o_union", ["sku", "customer", "period_year", "country", "net_revenue", "gross_profit"],
    ["net_revenue", "gross_profit"])
reg("d08_label_accounts",
    lambda st: st.pnl_fx.select("sku", "customer", "period_year", "account", *output.labels("account")),
    f"(SELECT sku, customer, period_year, account, {O.label_case('account', 1)} AS ACCOUNT_LVL_1, "
    f"{O.label_case('account', 2)} AS ACCOUNT_LVL_2, {O.label_case('account', 3)} AS ACCOUNT_LVL_3 FROM o_fx) t",
    ["sku", "customer", "period_year", "account", "ACCOUNT_LVL_1", "ACCOUNT_LVL_2", "ACCOUNT_LVL_3"])
reg("d09_planning_net_revenue", lambda st: st.planning_net_revenue, "o_plan_net_revenue", PE_COLS, planning.VALUES)


def _derived_sql(name: str, parts: Sequence[str]) -> str:
    sums = ", ".join(" + ".join(f"SUM(value_{v}) FILTER (WHERE cuenta = '{p}')" for p in parts) + f" AS {v}" for v in ("lcl", "usd"))
    return f"SELECT {', '.join(PLAN_KEYS11)}, '{name}' AS cuenta, {sums} FROM o_plan GROUP BY {', '.join(PLAN_KEYS11)}"


reg("d09_derived_accounts",
    lambda st: derive_long(st.planning_enriched, PLAN_KEYS11, "cuenta", planning.VALUES, job_formulas("null")),
    f"(SELECT {', '.join(PLAN_KEYS11)}, cuenta, COALESCE(lcl, 0) AS value_lcl, COALESCE(usd, 0) AS value_usd FROM ("
    + _derived_sql("NET_REVENUE", ["GROSS_SALES", "G2N"]) + " UNION ALL "
    + _derived_sql("GROSS_PROFIT", ["GROSS_SALES", "G2N", "COGS_MANUFACTURING", "COGS_LOGISTIC"])
    + ") d WHERE lcl IS NOT NULL OR usd IS NOT NULL) t", PE_COLS, planning.VALUES)
reg("d11_full_pnl", lambda st: st.result, "o_result", rules.OUTPUT_COLUMNS, FINAL_NUMS)


# ----------------------------------------------------------------------------
def run(name: str, spark: SparkSession, sf_dir: str, params: JobParams | None = None) -> DataFrame:
    qy = REGISTRY[name]
    st = Stages(derived_inputs(spark, sf_dir), params or synthetic_params())
    return as_output(qy.spark(st), qy.cols, qy.nums)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in REGISTRY}


def oracle_sql(params: JobParams | None = None) -> dict[str, str]:
    p = params or synthetic_params()
    return {name: O.oracle_query(p, _final_select(qy)) for name, qy in REGISTRY.items() if qy.oracle is not None}
