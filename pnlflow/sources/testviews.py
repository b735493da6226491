"""Logical job inputs derived from the TPC-H-like test tables.

The job reads eleven inputs (ledger lines, product / brand / customer
hierarchies, reporting facts, account and entity hierarchies, exchange
rates, country clusters and planning facts).  The test data has none of
them, so each is derived from the driver's tables with a deterministic SQL
view.  The same view text runs in Spark (``spark.sql`` with DataFrame
arguments) and in DuckDB (as a ``WITH`` prologue of every oracle query), so
both engines see identical inputs.  Only two expressions differ between
the dialects; they are passed in through ``Dialect``.

The views put the test rows into the original code space (companies,
entities, account codes, hierarchy labels) and deliberately create the edge
cases the rules must handle (the fact views keep every row of their source
tables; modulo expressions only decide codes, NULLs and which dimension rows
are missing): NULL and all-zero materials, NULL / default /
excluded customers, orphan SKUs and customers, zero, negative and NULL
volumes, NULL cost components, a brand with two descriptions, an account
code that sits in two hierarchy levels, a duplicated account row, a month
label that cannot be parsed and a country with two cluster rows.
"""

from __future__ import annotations

import dataclasses


@dataclasses.dataclass(frozen=True)
class Dialect:
    name: str

    def fiscal_period(self, expr: str) -> str:
        """Date -> 'YYYY0MM' text."""
        if self.name == "spark":
            return f"date_format({expr}, \"yyyy'0'MM\")"
        return f"strftime({expr}, '%Y0%m')"

    def int_div(self, a: str, b: str) -> str:
        if self.name == "spark":
            return f"({a} div {b})"
        return f"({a} // {b})"

    def table(self, name: str) -> str:
        # Spark receives the raw tables as DataFrame arguments of spark.sql
        return "{" + name + "}" if self.name == "spark" else name


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

# raw columns each view needs (column pruning at the parquet scan)
RAW_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "part": ["p_partkey", "p_brand", "p_type", "p_size"],
    "nation": ["n_nationkey", "n_name"],
}

COST_MAN_WEIGHTS = ("0.20", "0.12", "0.08", "0.06", "0.05", "0.04", "0.03", "0.02")
COST_LOG_WEIGHTS = ("0.50", "0.25", "0.15", "0.10")


def ledger_lines(d: Dialect) -> str:
    t = d.table
    man = ",\n".join(
        (f"CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(ROUND(price * {w}, 2) AS DECIMAL(18,2)) END"
         if i == len(COST_MAN_WEIGHTS) else f"CAST(ROUND(price * {w}, 2) AS DECIMAL(18,2))") + f" AS cost_man_{i}"
        for i, w in enumerate(COST_MAN_WEIGHTS, start=1))
    log = ",\n".join(
        (f"CASE WHEN l_linenumber = 6 AND l_suppkey % 2 = 0 THEN NULL "
         f"ELSE CAST(ROUND(price * tax * {w}, 2) AS DECIMAL(18,2)) END"
         if i == len(COST_LOG_WEIGHTS) else f"CAST(ROUND(price * tax * {w}, 2) AS DECIMAL(18,2))") + f" AS cost_log_{i}"
        for i, w in enumerate(COST_LOG_WEIGHTS, start=1))
    return f"""
SELECT
  {d.fiscal_period('l_shipdate')} AS fiscper,
  CASE WHEN l_linestatus = 'F' THEN 'UY02' ELSE 'PE02' END AS comp_code,
  CASE WHEN l_partkey % 50 = 7 THEN NULL ELSE lpad(CAST(l_partkey AS STRING), 10, '0') END AS material,
  CASE WHEN o_custkey % 11 = 0 THEN NULL
       WHEN o_custkey % 11 = 5 THEN '#'
       WHEN o_custkey % 101 = 17 THEN 'PL1048'
       ELSE lpad(CAST(o_custkey AS STRING), 10, '0') END AS customer,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS doc_number,
  CAST(l_shipdate AS DATE) AS pstng_date,
  CASE WHEN l_orderkey % 89 = 1 THEN NULL WHEN o_orderstatus = 'P' THEN 'USD' ELSE 'UYU' END AS currency,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'IC'
       WHEN l_returnflag = 'N' THEN 'GS' ELSE 'UD' END AS indicator_a,
  CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 4 THEN 'XX' ELSE 'ES' END AS indicator_b,
  CAST(CASE WHEN l_partkey % 10 = 0 OR p_brand = 'Brand#13' OR p_type = 'ECONOMY' THEN 0
            WHEN l_suppkey % 31 = 0 THEN NULL
            WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(18,2)) AS volume,
  CAST(price AS DECIMAL(18,2)) AS gross,
  CAST(-ROUND(price * disc, 2) AS DECIMAL(18,2)) AS trade_incentive,
  CAST(-ROUND(price * disc * 0.25, 2) AS DECIMAL(18,2)) AS consumer_incentive,
  CAST(-ROUND(price * tax * 0.10, 2) AS DECIMAL(18,2)) AS other_deduction,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(-ROUND(price * 0.01, 2) AS DECIMAL(18,2)) END AS allowance,
  CAST(CASE WHEN l_returnflag = 'R' THEN -ROUND(price * 0.02, 2) ELSE 0 END AS DECIMAL(18,2)) AS returns,
  CAST(CASE WHEN l_partkey % 3 = 0 THEN -ROUND(price * 0.005, 2) ELSE 0 END AS DECIMAL(18,2)) AS npd,
{man},
{log}
FROM (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus,
         l.l_shipdate, o.o_custkey, o.o_orderstatus, p.p_brand, p.p_type,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax
  FROM {t('lineitem')} l
  JOIN {t('orders')} o ON l.l_orderkey = o.o_orderkey
  JOIN {t('part')} p ON l.l_partkey = p.p_partkey
) x"""


def product_hier(d: Dialect) -> str:
    return f"""
SELECT 'SK' || CAST(p_partkey AS STRING) AS sku,
       p_type AS category,
       CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS bws,
       p_type || '|' || p_brand AS bws_desc,
       CASE WHEN p_partkey % 19 = 0 THEN NULL
            ELSE p_type || '|' || p_brand || '|' || CAST(p_size % 5 AS STRING) END AS ff
FROM {d.table('part')}
WHERE p_partkey % 17 <> 0"""


def brand_hier(d: Dialect) -> str:
    p = d.table("part")
    return f"""
SELECT DISTINCT p_brand AS brand_segment, 'BRP ' || p_brand AS brand FROM {p} WHERE p_brand <> 'Brand#7'
UNION ALL
SELECT DISTINCT p_brand AS brand_segment, 'BRP ALT' AS brand FROM {p} WHERE p_brand = 'Brand#9'"""


def _areas(d: Dialect) -> str:
    c = d.table("customer")
    return f"""
  SELECT 'SA' || CAST(c_custkey AS STRING) AS area_id, c_custkey, c_nationkey, c_mktsegment FROM {c}
  UNION ALL
  SELECT 'SB' || CAST(c_custkey AS STRING) AS area_id, c_custkey, c_nationkey, c_mktsegment FROM {c}
  WHERE c_custkey % 50 = 3"""


def customer_flat(d: Dialect) -> str:
    return f"""
SELECT a.area_id,
       CASE WHEN a.c_nationkey % 7 = 6 THEN 'AR02' ELSE 'UY02' END AS sales_org,
       CASE WHEN a.c_custkey % 17 = 0 THEN 'B' ELSE 'A' END AS hierarchy_type,
       CASE a.c_mktsegment WHEN 'BUILDING' THEN 'MODERN TRADE' WHEN 'AUTOMOBILE' THEN 'TRADITIONAL TRADE'
            WHEN 'MACHINERY' THEN 'TT Export' WHEN 'FURNITURE' THEN 'EXP-EXPORTS-1'
            ELSE 'HOUSEHOLD TRADE' END AS level2,
       n.n_name AS level5
FROM ({_areas(d)}) a
JOIN {d.table('nation')} n ON a.c_nationkey = n.n_nationkey"""


def customer_area(d: Dialect) -> str:
    return f"""
SELECT area_id, CAST(c_custkey AS STRING) AS customer_id FROM ({_areas(d)}) a"""


def customer_dim(d: Dialect) -> str:
    c = d.table("customer")
    return f"""
SELECT CAST(c_custkey AS STRING) AS customer_id, c_name AS customer_name FROM {c} WHERE c_custkey % 13 <> 0
UNION ALL
SELECT CAST(c_custkey AS STRING) AS customer_id, c_name || ' ALT' AS customer_name FROM {c}
WHERE c_custkey % 97 = 1 AND c_custkey % 13 <> 0"""


def reporting_facts(d: Dialect) -> str:
    base = f"""
  SELECT CASE WHEN l_partkey % 7 = 0 THEN 'PELFS' WHEN l_linestatus = 'F' THEN 'UYLFS' ELSE 'PELFS' END AS entity,
         CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_orderkey % 3 = 0 THEN 'SK' ELSE 'SKU_SK' END || CAST(l_partkey AS STRING) AS sku,
         CASE WHEN l_linenumber = 2 THEN 'USD' ELSE 'LCL' END AS currency,
         l_partkey, l_quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l_tax AS DECIMAL(4,2)) AS tax
  FROM {d.table('lineitem')}"""
    cols = "entity, date, sku, currency"
    return f"""
WITH rf AS ({base})
SELECT {cols}, 'A1001' AS account_code, CAST(-ROUND(price * 0.6305, 3) AS DECIMAL(18,3)) AS value FROM rf
UNION ALL
SELECT {cols}, 'A1002' AS account_code, CAST(-ROUND(price * tax * 1.05, 3) AS DECIMAL(18,3)) AS value FROM rf
UNION ALL
SELECT {cols}, CASE WHEN l_partkey % 11 = 0 THEN 'A2003' ELSE 'A2001' END AS account_code,
       CAST(ROUND(price * 1.05, 3) AS DECIMAL(18,3)) AS value FROM rf
UNION ALL
SELECT {cols}, 'A2002' AS account_code, CAST(-ROUND(price * disc * 1.05, 3) AS DECIMAL(18,3)) AS value FROM rf
UNION ALL
SELECT {cols}, 'PLV959999' AS account_code, CAST(l_quantity AS DECIMAL(18,3)) AS value FROM rf
UNION ALL
SELECT {cols}, 'A3001' AS account_code, CAST(ROUND(price * 0.1, 3) AS DECIMAL(18,3)) AS value FROM rf"""


def _values(rows: list[tuple[str, ...]], names: list[str]) -> str:
    body = ",\n  ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES\n  {body}\n) AS v({', '.join(names)})"


# A synthetic account hierarchy: leaf code -> levels 5 / 7 / 8 with descriptions.
# A1002 is listed twice (duplicate row), A2003 sits under gross sales on level 7
# and under manufacturing cost on level 8, A3001 is in no used level.
ACCOUNT_ROWS = [
    ("A1001", "PL213999", "Gross profit", "PL210000", "Cost of sales", "PL211005", "Manufacturing cost"),
    ("A1002", "PL213999", "Gross profit", "PL210000", "Cost of sales", "PL212099", "Logistic cost"),
    ("A1002", "PL213999", "Gross profit", "PL210000", "Cost of sales", "PL212099", "Logistic cost"),
    ("A2001", "PL213999", "Gross profit", "PL201010", "Gross sales", "PL201011", "Gross sales detail"),
    ("A2002", "PL213999", "Gross profit", "PL202000", "Gross to net", "PL202001", "Gross to net detail"),
    ("A2003", "PL213999", "Gross profit", "PL201010", "Gross sales", "PL211005", "Manufacturing cost"),
    ("PLV959999", "PLV959999", "Volume", "PLV959999", "Volume", "PLV959999", "Volume"),
    ("A3001", "PL299999", "Other", "PL290000", "Other", "PL291000", "Other"),
]
ACCOUNT_NAMES = ["account_code", "level_05", "level_05_description", "level_07", "level_07_description",
                 "level_08", "level_08_description"]


def account_hier(d: Dialect) -> str:
    return _values(ACCOUNT_ROWS, ACCOUNT_NAMES)


def entity_hier(d: Dialect) -> str:
    return _values([("UYLFS",), ("PELFS",), ("CLLFS",)], ["entity"])


def country_clusters(d: Dialect) -> str:
    return _values([
        ("Uruguay", "South", "UY", "UYLFS"),
        ("uruguay", "South B", "UY B", "UYX"),
        ("Paraguay", "South", "PY", "PYLFS"),
        ("Chile", "Andes", "CL", "CLLFS"),
    ], ["country", "cluster1", "cluster2", "fit_entity"])


_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def fx_rates(d: Dialect) -> str:
    month_case = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MONTHS, start=1))
    return f"""
SELECT year,
       CASE WHEN year = 2000 AND m = 12 THEN 'DEC' ELSE CASE m {month_case} END END AS period,
       CASE WHEN scenario = 'Bud' THEN 'Draft' ELSE 'Final' END AS version,
       currency, scenario,
       CAST(CAST({d.int_div('SUM(cents)', 'COUNT(*)')} AS DECIMAL(18,0)) * 0.000001 AS DECIMAL(18,6)) AS value,
       'Avg_Rate' AS account
FROM (
  SELECT CAST(YEAR(o_orderdate) AS BIGINT) AS year, MONTH(o_orderdate) AS m,
         CASE o_orderstatus WHEN 'F' THEN 'UYU' WHEN 'O' THEN 'PEN' ELSE 'USD' END AS currency,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Act'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'AC' ELSE 'Bud' END AS scenario,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents
  FROM {d.table('orders')}
) r
GROUP BY year, m, currency, scenario"""


def planning_facts(d: Dialect) -> str:
    return f"""
SELECT scenario, date, account, entity, product, currency, channel, version,
       CASE WHEN sgn < 0 THEN -amount ELSE amount END AS value_lcl,
       CASE WHEN l_suppkey % 37 = 0 THEN NULL
            ELSE CAST(ROUND(CASE WHEN sgn < 0 THEN -amount ELSE amount END * 0.05, 2) AS DECIMAL(18,2)) END AS value_usd
FROM (
  SELECT CASE WHEN o.o_orderpriority = '5-LOW' THEN 'BUD' ELSE 'AC' END AS scenario,
         make_date(YEAR(l.l_shipdate), MONTH(l.l_shipdate), 1) AS date,
         CASE l.l_linenumber % 6 WHEN 0 THEN 'A1001' WHEN 1 THEN 'A1002' WHEN 2 THEN 'A2001'
              WHEN 3 THEN 'A2002' WHEN 4 THEN 'PLV959999' ELSE 'PLC203000_50' END AS account,
         CASE WHEN l.l_linestatus = 'F' THEN 'UYLFS' ELSE 'PELFS' END AS entity,
         CASE WHEN p.p_partkey % 29 = 0 THEN 'NOBWS' ELSE p.p_brand END AS product,
         'LCL' AS currency,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MT' ELSE 'TT' END AS channel,
         'V1' AS version,
         l.l_suppkey,
         CASE WHEN l.l_linenumber % 6 = 4 THEN CAST(l.l_quantity AS DECIMAL(18,2))
              ELSE CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(10,2)) * 1.1, 2) AS DECIMAL(18,2)) END AS amount,
         CASE WHEN l.l_linenumber % 6 IN (0, 1, 3) THEN -1 ELSE 1 END AS sgn
  FROM {d.table('lineitem')} l
  JOIN {d.table('orders')} o ON l.l_orderkey = o.o_orderkey
  JOIN {d.table('part')} p ON l.l_partkey = p.p_partkey
) x"""


# logical input -> (view builder, raw tables it reads)
VIEWS = {
    "ledger_lines": (ledger_lines, ("lineitem", "orders", "part")),
    "product_hier": (product_hier, ("part",)),
    "brand_hier": (brand_hier, ("part",)),
    "customer_flat": (customer_flat, ("customer", "nation")),
    "customer_area": (customer_area, ("customer",)),
    "customer_dim": (customer_dim, ("customer",)),
    "reporting_facts": (reporting_facts, ("lineitem",)),
    "account_hier": (account_hier, ()),
    "entity_hier": (entity_hier, ()),
    "fx_rates": (fx_rates, ("orders",)),
    "country_clusters": (country_clusters, ()),
    "planning_facts": (planning_facts, ("lineitem", "orders", "part")),
}


def duckdb_prologue(names: list[str] | None = None) -> str:
    """``name AS (view), ...`` for a DuckDB WITH clause over the raw tables."""
    names = list(VIEWS) if names is None else names
    return ",\n".join(f"{n} AS ({VIEWS[n][0](DUCKDB)}\n)" for n in names)
