"""Dimension stages: product and customer hierarchies, their joins and orphan reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.rules import JobParams

PRODUCT_ATTRS = ["category", "bsp", "brand", "ff"]
CUSTOMER_ATTRS = ["customer_name", "channel", "subchannel"]
LEDGER_PRODUCT_KEYS = ["country", "customer", "period_year", "sku", "currency_copa", "sales_order",
                       "category", "bsp", "brand", "ff"]
ACTUALS_KEYS = ["sku", "country", "customer", "customer_name", "channel", "subchannel", "period_year",
                "sales_order", "currency_copa", "category", "bsp", "brand", "ff"]
MEASURES = ["cogs_logistic", "cogs_manufacturing", "g2n", "gross_sales", "volume_net"]


def product_dim(product_hier: DataFrame, brand_hier: DataFrame) -> DataFrame:
    """Product hierarchy with its brand description (left join; a brand segment
    listed twice fans the SKU out)."""
    brands = brand_hier.select("brand_segment", "brand")
    return (product_hier.join(brands, product_hier["bws"] == brands["brand_segment"], "left")
            .select("sku", "category", "brand", F.col("bws_desc").alias("bsp"), "ff"))


def customer_dim(customer_flat: DataFrame, customer_area: DataFrame, customer: DataFrame,
                 p: JobParams) -> DataFrame:
    """Flattened sales-area hierarchy -> sales area -> customer (inner chain)."""
    flat = (customer_flat
            .where((F.col("hierarchy_type") == F.lit(rules.CUSTOMER_HIERARCHY_TYPE))
                   & (F.col("sales_org") == F.lit(p.company))
                   & F.col("level2").isin(*rules.CHANNEL_BY_LEVEL2))
            .select("area_id", F.col("sales_org").alias("bu"),
                    S.label("level2", rules.CHANNEL_BY_LEVEL2, F.col("level2")).alias("channel"),
                    F.col("level5").alias("subchannel")))
    areas = customer_area.select("area_id", "customer_id")
    names = customer.select("customer_id", "customer_name")
    return (flat.join(areas, "area_id").join(names, "customer_id")
            .select("bu", "channel", "subchannel", F.col("customer_id").alias("customer"), "customer_name"))


def attach_product(conformed: DataFrame, product: DataFrame) -> DataFrame:
    """J3 + A3: inner join on SKU, then sum by the ten keys."""
    return (conformed.join(product, "sku", "inner")
            .groupBy(*LEDGER_PRODUCT_KEYS)
            .agg(*[F.sum(m).alias(m) for m in MEASURES]))


def orphan_report(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str],
                  measures: Sequence[str] = MEASURES) -> DataFrame:
    """D10 (J4 / J6): measures of fact rows whose key has no dimension row, summed by ``by``."""
    keys = dim.select(key).where(F.col(key).isNotNull()).distinct()
    return (fact.join(keys, key, "left_anti")
            .groupBy(*by)
            .agg(*[F.sum(m).alias(m) for m in measures]))


def join_customer_attributes(ledger_product: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join to the distinct customer attributes; a customer with several fans out."""
    attrs = customers.select("customer", *CUSTOMER_ATTRS).distinct()
    return ledger_product.join(attrs, "customer", "left")


def attach_customer(ledger_product: DataFrame, customers: DataFrame) -> DataFrame:
    """J5 + A5: attach the customer attributes, then collapse exact key duplicates with MAX."""
    return (join_customer_attributes(ledger_product, customers)
            .groupBy(*ACTUALS_KEYS)
            .agg(*[F.max(m).alias(m) for m in MEASURES]))


MATCHES = ["has_product", "has_customer"]


def attach_dimensions(conformed: DataFrame, product: DataFrame, customers: DataFrame) -> DataFrame:
    """J3-J6, A3 and A5 in one pass over the fact: both dimensions are attached by LEFT joins
    that leave a flag, so the matched rows (``has_product``), the rows of unknown SKUs (not
    ``has_product``) and of unknown customers (not ``has_customer``) are parts of one table.
    Rows of unknown SKUs take no customer attributes, hence do not fan out."""
    known = product.withColumn("has_product", F.lit(True))
    with_product = (conformed.join(known, "sku", "left")
                    .withColumn("has_product", F.coalesce("has_product", F.lit(False)))
                    .groupBy(*LEDGER_PRODUCT_KEYS, "has_product")
                    .agg(*[F.sum(m).alias(m) for m in MEASURES]))
    attrs = (customers.select(F.col("customer").alias("__customer"), *CUSTOMER_ATTRS).distinct()
             .withColumn("has_customer", F.lit(True)))
    return (with_product.join(attrs, F.col("has_product") & (F.col("customer") == F.col("__customer")), "left")
            .withColumn("has_customer", F.coalesce("has_customer", F.lit(False)))
            .groupBy(*ACTUALS_KEYS, *MATCHES)
            .agg(*[F.max(m).alias(m) for m in MEASURES]))


def orphan_totals(flagged: DataFrame, period: str = "period_year") -> DataFrame:
    """A6 and A7 from the flagged table: per period the manufacturing cost of rows without SKU or
    customer, and the volume of the rows it is spread over.  Periods without such rows have no
    entry."""
    orphan = ~F.col("has_product") | ~F.col("has_customer")
    return (flagged.groupBy(period)
            .agg(F.sum(F.when(orphan, F.col("cogs_manufacturing"))).alias("pool_cost"),
                 F.sum(F.when(F.col("has_product"), F.col("volume_net"))).alias("period_volume"),
                 F.count_if(orphan).alias("__orphans"))
            .where("__orphans > 0").drop("__orphans"))
