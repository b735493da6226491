"""Reporting-system side: account extracts (J9, A10), pivot (R1) and measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.operators.accounts import evaluate, job_formulas
from pnlflow.operators.joins import stored
from pnlflow.operators.reshape import pivot_sum
from pnlflow.rules import JobParams
from pnlflow.sources.layout import in_window

REPORTING_MEASURES = ["COGS_MANUFACTURING", "COGS_LOGISTIC", "GROSS_SALES", "G2N", "VOLUME"]


def reporting_scope(facts: DataFrame, p: JobParams) -> DataFrame:
    """One entity, local currency, strictly after the start date (no upper bound)."""
    return in_window(facts, p.reporting_start, None).where((F.col("entity") == F.lit(p.entity))
                       & (F.col("currency") == F.lit(rules.REPORTING_CURRENCY))
                       & (F.col("date") > F.lit(p.reporting_start)))


def extract_map(accounts: DataFrame, entities: DataFrame, p: JobParams) -> DataFrame:
    """(entity, account code) -> extract and account: the level-8 and level-7 accounts through the
    account and entity hierarchies (a duplicated row of either counts twice, a code under two
    levels is in both extracts), and the leaf volume codes as they are (extract 0)."""
    acct = accounts.select("account_code", "level_08", "level_07")
    levels = (acct.where(F.col("level_08").isin(*rules.REPORTING_LEVEL_08))
              .select("account_code", F.lit(8).alias("extract"), F.col("level_08").alias("account"))
              .unionByName(acct.where(F.col("level_07").isin(*rules.REPORTING_LEVEL_07))
                           .select("account_code", F.lit(7).alias("extract"), F.col("level_07").alias("account"))))
    own = entities.where(F.col("entity") == F.lit(p.entity)).select("entity")
    leaf = accounts.sparkSession.createDataFrame([(p.entity, c, 0, c) for c in rules.REPORTING_LEAF],
                                                 "entity string, account_code string, extract int, account string")
    keyed = levels.withColumn("entity", F.lit(p.entity)).join(own, "entity")
    return keyed.select("entity", "account_code", "extract", "account").unionByName(leaf)


def join_accounts(scoped: DataFrame, mapping: DataFrame) -> DataFrame:
    """Facts with the extracts and accounts that they count for."""
    return scoped.join(mapping, ["entity", "account_code"])


EXTRACT_KEYS = ["extract", "entity", "period_year", "account", "sku"]
WIDE_KEYS = ["period_year", "country", "sku"]


def account_extracts(facts: DataFrame, accounts: DataFrame, entities: DataFrame, p: JobParams, tasks: int | None = None) -> DataFrame:
    """J9 + A10: amounts per entity, period, account and SKU, rounded to cents per extract.  All
    three extracts come from one scan of the facts and one join.  ``tasks``: the rows are dealt to so many partitions
    before they are summed, so that what a task holds does not grow with the facts."""
    scoped = reporting_scope(facts, p).select(
        "entity", S.fiscal_period("date").alias("period_year"), "account_code",
        S.replace_text("sku", rules.REPORTING_SKU_PREFIX, rules.SKU_PREFIX).alias("sku"), "value")
    keyed = join_accounts(scoped, stored(extract_map(accounts, entities, p)))
    return ((keyed if tasks is None else keyed.repartition(tasks, *EXTRACT_KEYS)).groupBy(*EXTRACT_KEYS)
            .agg(F.round(F.sum("value"), 2).alias("value")))


def reporting_wide(extracts: DataFrame, tasks: int | None = None) -> DataFrame:
    """C3 + R1: account code -> measure, entity -> country, pivot the five measures (in ``tasks`` partitions, if given)."""
    labelled = extracts.select(
        "period_year",
        S.label("account", rules.ACCOUNT_MEASURE).alias("account"),
        S.label("entity", rules.ENTITY_COUNTRY).alias("country"),
        "sku", "value")
    return pivot_sum(labelled if tasks is None else labelled.repartition(tasks, *WIDE_KEYS), WIDE_KEYS, "account", "value", REPORTING_MEASURES)


def reporting_measures(wide: DataFrame) -> DataFrame:
    """A11 + D7: per (sku, period, country) with sign flips and derived net revenue /
    gross profit.  The pivot already yields one row per key, so no regrouping."""
    made = evaluate(job_formulas("zero"), {m: F.col(m) for m in REPORTING_MEASURES})
    return wide.select(
        "sku", "period_year", "country",
        S.negate(S.zero_if_null("COGS_MANUFACTURING")).alias("cogs_manufacturing"),
        S.negate("COGS_LOGISTIC").alias("cogs_logistic"),
        F.col("GROSS_SALES").alias("gross_sales"),
        S.negate("G2N").alias("g2n"),
        F.col("VOLUME").alias("volume"),
        made["NET_REVENUE"].alias("net_revenue"),
        made["GROSS_PROFIT"].alias("gross_profit"))
