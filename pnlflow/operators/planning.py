"""Planning side: base rollup (A19), product rollup (A20), account map (U6),
enrichment (J14-J16, A22) and derived net revenue (D9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.operators.accounts import derive_long, job_formulas
from pnlflow.operators.joins import stored
from pnlflow.rules import JobParams
from pnlflow.sources.layout import in_window

BASE_KEYS = ["scenario", "date", "account", "entity", "product", "currency", "channel", "version"]
ENRICHED_KEYS = ["sku", "channel", "category", "date", "scenario", "format_flavor", "subbrand", "brand",
                 "area", "cluster", "market", "cuenta"]
VALUES = ["value_lcl", "value_usd"]


def planning_base(facts: DataFrame, p: JobParams) -> DataFrame:
    """A19 (+ F1, F4, F7, F8): one scenario and entity, excluded accounts dropped, date window."""
    return (in_window(facts, p.period_start, p.period_end).where((F.col("scenario") == F.lit(rules.PLANNING_SCENARIO))
                        & ~F.col("account").isin(*rules.PLANNING_EXCLUDED_ACCOUNTS)
                        & F.col("entity").isin(p.entity)
                        & F.col("date").between(F.lit(p.period_start), F.lit(p.period_end)))
            .groupBy(*BASE_KEYS)
            .agg(*[F.sum(v).alias(v) for v in VALUES]))


def product_rollup(product_hier: DataFrame, brand_hier: DataFrame) -> DataFrame:
    """A20 (+ J1): one row per (category, brand, brand segment, sub-brand) with an
    arbitrary SKU and format/flavor; MIN makes the choice deterministic.  Each is the least of its own
    column, so the SKU and the flavor may be those of different products."""
    brands = brand_hier.select("brand_segment", "brand")
    return (product_hier.join(brands, product_hier["bws"] == brands["brand_segment"], "left")
            .groupBy("category", "brand", "bws", F.col("bws_desc").alias("subbrand"))
            .agg(F.min("ff").alias("format_flavor"), F.min("sku").alias("sku")))


def account_map(accounts: DataFrame) -> DataFrame:
    """U6 (+ A21): code -> account from three hierarchy levels, each level de-duplicated;
    a code under several levels maps to several accounts."""
    def level(n: str, codes: tuple[str, ...]) -> DataFrame:
        return (accounts.where(F.col(f"level_{n}").isin(*codes))
                .select("account_code", F.col(f"level_{n}").alias("account"),
                        F.col(f"level_{n}_description").alias("description"))
                .distinct())
    return (level("05", rules.PLANNING_LEVEL_05)
            .unionByName(level("08", rules.PLANNING_LEVEL_08))
            .unionByName(level("07", rules.PLANNING_LEVEL_07)))


def cluster_lookup(clusters: DataFrame, entity: str | None = None) -> DataFrame:
    """C12 (J13 / J16): upper-cased country -> clusters, optionally for one entity."""
    c = clusters if entity is None else clusters.where(F.col("fit_entity") == F.lit(entity))
    return c.select(F.upper("country").alias("country_key"), "cluster1", "cluster2")


def attach_products(base: DataFrame, products: DataFrame) -> DataFrame:
    """Left join to the product rollup."""
    return base.join(products, base["product"] == products["bws"], "left")


def attach_accounts(base: DataFrame, accounts: DataFrame) -> DataFrame:
    """Inner join to the account map; a code under several levels fans out."""
    mapping = accounts.select("account_code", F.col("account").alias("level_account"))
    return base.join(mapping, F.col("account") == F.col("account_code"), "inner")


def attach_clusters(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join to the clusters of the row's country; may fan out."""
    return df.join(lookup, F.col("country") == F.col("country_key"), "left")


def with_country(base: DataFrame) -> DataFrame:
    """The country of the planning entity."""
    return base.withColumn("country", S.label("entity", rules.PLANNING_ENTITY_COUNTRY))


def planning_enriched(base: DataFrame, product_hier: DataFrame, brand_hier: DataFrame, accounts: DataFrame,
                      clusters: DataFrame) -> DataFrame:
    """J14 + J15 + J16 + A22: product rollup (left), account map (inner, may fan out),
    clusters for every entity (left, may fan out), summed by twelve keys."""
    joined = attach_clusters(
        attach_accounts(attach_products(with_country(base), stored(product_rollup(product_hier, brand_hier))),
                        stored(account_map(accounts))),
        cluster_lookup(clusters))
    return (joined.groupBy(
                "sku", "channel", "category", "date", "scenario", "format_flavor", "subbrand", "brand",
                F.col("cluster1").alias("area"), F.col("cluster2").alias("cluster"),
                F.col("country_key").alias("market"),
                S.label("level_account", rules.PLANNING_ACCOUNT_MEASURE).alias("cuenta"))
            .agg(*[F.sum(v).alias(v) for v in VALUES]))


def planning_net_revenue(enriched: DataFrame) -> DataFrame:
    """Net revenue = gross sales + gross-to-net (raw signs) per key, separately
    for both value columns.  A value without both parts is NULL and yields no
    row; when only one value column has a result the other one is 0.

    This is the single aggregate that the pivot -> derive -> unpivot -> filter
    chain reduces to (the label filter cannot be pushed through a generic
    unpivot)."""
    return derive_long(enriched, [k for k in ENRICHED_KEYS if k != "cuenta"], "cuenta", VALUES, job_formulas("null"), ["NET_REVENUE"]).select(
        *enriched.columns)
