"""Declared columns of the job's inputs: name -> type.

Sources are read by these names and cast to these types, so money is an exact decimal
whatever the source stores.  A source with other column names is mapped (logical name ->
source column)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.sources.layout import FACT_DATES, PERIOD

AMOUNT, RATE = "decimal(18,2)", "decimal(18,6)"


def _columns(text: str, kind: str = "string") -> dict[str, str]:
    return {c: kind for c in text.split()}


_LEDGER_AMOUNTS = ("volume gross trade_incentive consumer_incentive other_deduction allowance returns npd "
                   + " ".join(f"cost_man_{i}" for i in range(1, 9)) + " " + " ".join(f"cost_log_{i}" for i in range(1, 5)))
_ACCOUNTS = _columns("account_code level_05 level_05_description level_07 level_07_description level_08 level_08_description")

SCHEMAS: dict[str, dict[str, str]] = {
    "ledger_lines": {**_columns("fiscper comp_code material customer doc_number"), "pstng_date": "date",
                     **_columns("currency indicator_a indicator_b"), **_columns(_LEDGER_AMOUNTS, AMOUNT)},
    "product_hier": _columns("sku category bws bws_desc ff"),
    "brand_hier": _columns("brand_segment brand"),
    "customer_flat": _columns("area_id sales_org hierarchy_type level2 level5"),
    "customer_area": _columns("area_id customer_id"),
    "customer_dim": _columns("customer_id customer_name"),
    "reporting_facts": {"entity": "string", "date": "date", **_columns("sku currency account_code"), "value": "decimal(18,3)"},
    "account_hier": _ACCOUNTS,
    "entity_hier": _columns("entity"),
    "fx_rates": {"year": "bigint", **_columns("period version currency scenario"), "value": RATE, "account": "string"},
    "country_clusters": _columns("country cluster1 cluster2 fit_entity"),
    "planning_facts": {"scenario": "string", "date": "date", **_columns("account entity product currency channel version"),
                       "value_lcl": AMOUNT, "value_usd": AMOUNT},
    "planning_account_hier": _ACCOUNTS,
}


def conform(df: DataFrame, name: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """The declared columns of input ``name`` in their types.  ``mapping`` gives the source column of
    a logical one where it differs.  A missing column is an error."""
    source = {c: (mapping or {}).get(c, c) for c in SCHEMAS[name]}
    if missing := sorted(s for s in source.values() if s not in df.columns):
        raise ValueError(f"{name}: no column {', '.join(missing)} among {', '.join(df.columns)}")
    laid_out = [PERIOD] if name in FACT_DATES and PERIOD in df.columns else []  # folders by month, for pruning
    return df.select(*[F.col(f"`{source[c]}`").cast(kind).alias(c) for c, kind in SCHEMAS[name].items()], *laid_out)
