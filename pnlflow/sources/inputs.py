"""Job inputs (S2-S6) and the result sink."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pnlflow.sources import testviews
from pnlflow.sources.schemas import conform

INPUT_NAMES = tuple(testviews.VIEWS)


@dataclasses.dataclass(frozen=True)
class Inputs:
    ledger_lines: DataFrame
    product_hier: DataFrame
    brand_hier: DataFrame
    customer_flat: DataFrame
    customer_area: DataFrame
    customer_dim: DataFrame
    reporting_facts: DataFrame
    account_hier: DataFrame
    entity_hier: DataFrame
    fx_rates: DataFrame
    country_clusters: DataFrame
    planning_facts: DataFrame
    #: Account hierarchy of the planning side, if it is kept apart from the reporting side's.
    planning_account_hier: DataFrame | None = None

    @property
    def planning_accounts(self) -> DataFrame:
        return self.account_hier if self.planning_account_hier is None else self.planning_account_hier


def read_inputs(spark: SparkSession, locations: Mapping[str, str], fmt: str = "parquet",
                columns: Mapping[str, Mapping[str, str]] | None = None) -> Inputs:
    """Production inputs: one path (or catalog table name when ``fmt == 'table'``) per logical input,
    in the declared columns and types; ``columns`` maps logical to source columns per input.
    ``planning_account_hier`` is optional.  Filters and column pruning of the stages reach
    these scans through Catalyst."""
    def read(name: str) -> DataFrame:
        loc = locations[name]
        df = spark.read.table(loc) if fmt == "table" else spark.read.format(fmt).load(loc)
        return conform(df, name, (columns or {}).get(name))
    optional = [n for n in ("planning_account_hier",) if n in locations]
    return Inputs(**{n: read(n) for n in (*INPUT_NAMES, *optional)})


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw test table with only the columns the views use (pruned at the scan)."""
    cols = testviews.RAW_COLUMNS.get(name)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def derived_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs derived from the TPC-H-like test tables (see ``testviews``)."""
    raw: dict[str, DataFrame] = {}
    views = {}
    for name, (builder, deps) in testviews.VIEWS.items():
        for d in deps:
            if d not in raw:
                raw[d] = raw_table(spark, sf_dir, d)
        views[name] = spark.sql(builder(testviews.SPARK), **{d: raw[d] for d in deps})
    return Inputs(**views)
