"""Output shaping: long form (A16 + R2), account labels (D8), final rollups (A18,
planning final) and the 22-column union (U8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.operators.planning import attach_clusters, cluster_lookup
from pnlflow.operators.reshape import unpivot_drop_nulls
from pnlflow.rules import JobParams

LONG_KEYS = ["sku", "customer", "customer_name", "country", "bsp", "brand", "category", "ff", "period_year",
             "channel", "subchannel", "currency_copa"]
FX_KEYS = [k for k in LONG_KEYS if k != "currency_copa"]
WIDE_MEASURES = ["gross_sales", "g2n", "net_revenue", "gross_profit", "volume", "cogs_logistic",
                 "cogs_manufacturing"]


def by_conversion(union: DataFrame, tasks: int | None = None) -> DataFrame:
    """The rows dealt by the conversion's keys, to ``tasks`` partitions (default: the session's number)."""
    return union.repartition(*([] if tasks is None else [tasks]), *FX_KEYS)


def pnl_wide(union: DataFrame, tasks: int | None = None) -> DataFrame:
    """The seven measures summed per twelve dimensions (column = account name).
    All seven get the money scale, so the long form holds one type without losing
    the allocated decimals (a common type of (38,2) and (38,6) would round to cents)."""
    # dealt by the conversion's keys: this rollup, the conversion and the final one all run on it
    return by_conversion(union, tasks).groupBy(*LONG_KEYS).agg(*[S.money(F.sum(m)).alias(m.upper()) for m in WIDE_MEASURES])


def pnl_long(union: DataFrame, tasks: int | None = None) -> DataFrame:
    """A16 + R2: one row per (dimensions, account) with NULL amounts dropped; the
    account is the upper-case measure name."""
    return unpivot_drop_nulls(pnl_wide(union, tasks), LONG_KEYS, list(rules.ACTUAL_MEASURES), "account", "amount")


def account_label(account: str | Column, level: int) -> Column:
    """Label of an account on hierarchy level 1, 2 or 3."""
    return S.label(account, {a: labels[level - 1] for a, labels in rules.ACCOUNT_LABELS.items()})


def labels(account: str) -> list[Column]:
    return [account_label(account, i).alias(f"ACCOUNT_LVL_{i}") for i in (1, 2, 3)]


FINAL_VALUES = {"value_ac_rate": "Value_AC_Rate", "value_py_rate": "Value_PY_Rate", "amount_usd": "Value_USD", "amount_lcl": "Value_LCL"}


def actuals_final(converted: DataFrame, clusters: DataFrame, p: JobParams, unique: bool = False) -> DataFrame:
    """J13 + A18 + C8: attach the market clusters of the run's entity, roll up and shape
    the output columns.  ``unique``: ``converted`` is known to have one row for each of its keys and account, as the
    conversion's aggregate leaves it.  Rows of one group can then only be copies that a repeated cluster row made, so
    the lookup is rolled up in place of the long rows, and each amount counts as often as its cluster row is there."""
    lookup = cluster_lookup(clusters, p.entity)
    if unique:
        lookup = lookup.repartition("country_key").groupBy("country_key", "cluster1", "cluster2").agg(F.count("*").alias("__copies"))
        copies = F.coalesce(F.col("__copies"), F.lit(1)).cast("decimal(20,0)")
        once = F.coalesce(F.col("__copies"), F.lit(1)) == 1
        agg = attach_clusters(converted, lookup).withColumns({c: F.when(once, F.col(c)).otherwise(S.money(F.col(c) * copies)) for c in FINAL_VALUES})
        agg = agg.withColumnsRenamed(FINAL_VALUES)
    else:
        agg = (attach_clusters(converted, lookup).groupBy("sku", "customer", "customer_name", "bsp", "brand", "category", "ff", "period_year",
                              "channel", "subchannel", "cluster1", "cluster2", "country", "account")
               .agg(*[F.sum(c).alias(name) for c, name in FINAL_VALUES.items()]))
    return agg.select(
        F.col("sku").alias("SKU"), F.col("customer").alias("CUSTOMER"),
        F.col("customer_name").alias("CUSTOMER_NAME"), F.col("brand").alias("BRAND"),
        F.col("bsp").alias("SUBBRAND"), F.col("category").alias("CATEGORY"),
        F.col("ff").alias("FORMAT_FLAVOR"), F.col("period_year").alias("PERIOD_YEAR"),
        S.period_to_date("period_year").alias("DATE"), F.col("channel").alias("CHANNEL"),
        F.col("subchannel").alias("SUBCHANNEL"), F.col("cluster1").alias("Area"),
        F.col("cluster2").alias("Cluster"), F.col("country").alias("Market"),
        F.lit(rules.ACTUAL_SCENARIO).alias("SCENARIO"), *labels("account"),
        *[F.col(c).cast("double").alias(c) for c in ("Value_AC_Rate", "Value_PY_Rate", "Value_USD", "Value_LCL")])


def planning_final(planning: DataFrame) -> DataFrame:
    """Planning rows in the output shape: dummy customer and channel (no regrouping,
    so duplicates on the visible columns are kept), gross-to-net sign flipped,
    no rate conversions."""
    dummy = F.lit(rules.DUMMY_KEY)
    flip = F.col("cuenta") == F.lit("G2N")

    def signed(v: str) -> Column:
        return F.when(flip, S.negate(v)).otherwise(F.col(v)).cast("double")

    return planning.select(
        F.col("sku").alias("SKU"), dummy.alias("CUSTOMER"), dummy.alias("CUSTOMER_NAME"),
        F.col("brand").alias("BRAND"), F.col("subbrand").alias("SUBBRAND"), F.col("category").alias("CATEGORY"),
        F.col("format_flavor").alias("FORMAT_FLAVOR"), S.fiscal_period("date").alias("PERIOD_YEAR"),
        F.col("date").alias("DATE"), dummy.alias("CHANNEL"), dummy.alias("SUBCHANNEL"),
        F.col("area").alias("Area"), F.col("cluster").alias("Cluster"), F.col("market").alias("Market"),
        F.col("scenario").alias("SCENARIO"), *labels("cuenta"),
        F.lit(0.0).alias("Value_AC_Rate"), F.lit(0.0).alias("Value_PY_Rate"),
        signed("value_usd").alias("Value_USD"), signed("value_lcl").alias("Value_LCL"))


def final_union(actuals: DataFrame, planning: DataFrame) -> DataFrame:
    """U8: actuals and planning in the fixed output column order."""
    cols = list(rules.OUTPUT_COLUMNS)
    return actuals.select(*cols).unionByName(planning.select(*cols))
