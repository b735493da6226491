"""Exchange rates and currency conversion (D6: A14, J11, A15, J12, A17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S
from pnlflow.rules import JobParams

RATE_COLUMNS = ["ACRate", "ActRate", "ACPYRate", "ActPYRate"]


def rate_base(rates: DataFrame) -> DataFrame:
    """C9 + F7/F8: average rates of the final version, first-of-month date."""
    return (rates.where((F.col("account") == F.lit(rules.FX_ACCOUNT))
                        & F.col("scenario").isin(rules.FX_SCENARIO_ACT, rules.FX_SCENARIO_ALT)
                        & (F.col("version") == F.lit(rules.FX_VERSION)))
            .select("year", S.month_name_date("year", "period", rules.MONTH_ABBREVIATIONS).alias("date"),
                    "period", "version", "currency", "scenario", "value"))


def scenario_max(name: str) -> F.Column:
    return F.max(F.when(F.col("scenario") == F.lit(name), F.col("value")))


def current_rates(base: DataFrame) -> DataFrame:
    """Both scenario rates side by side (scenario stays a grouping key)."""
    return (base.groupBy("year", "date", "period", "version", "currency", "scenario")
            .agg(scenario_max(rules.FX_SCENARIO_ALT).alias("ACRate"),
                 scenario_max(rules.FX_SCENARIO_ACT).alias("ActRate")))


def prior_year_rates(base: DataFrame) -> DataFrame:
    """A14 + C10: the rates of each month keyed by the same month one year later."""
    return (base.groupBy("year", "date", F.add_months("date", 12).alias("next_year_date"), "period", "version",
                         "currency")
            .agg(scenario_max(rules.FX_SCENARIO_ALT).alias("ACPYRate"),
                 scenario_max(rules.FX_SCENARIO_ACT).alias("ActPYRate")))


def exchange_rates(rates: DataFrame, p: JobParams) -> DataFrame:
    """J11 + A15: per (fiscal period, currency) the current rates of both
    scenarios and the prior-year rates (the rate whose date + 1 year is this
    date).  The date window applies to the current side only, so prior-year
    rates from before the window still count."""
    base = rate_base(rates)
    prior = prior_year_rates(base).select(
        "next_year_date", F.col("currency").alias("py_currency"), "ACPYRate", "ActPYRate")
    joined = (current_rates(base).where(F.col("date").between(F.lit(p.period_start), F.lit(p.period_end)))
              .join(prior, (F.col("date") == F.col("next_year_date")) & (F.col("currency") == F.col("py_currency")),
                    "left"))
    return (joined.groupBy(S.fiscal_period("date").alias("fiscper"), "currency")
            .agg(*[F.max(c).alias(c) for c in RATE_COLUMNS]))


def attach_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """The three rates of each row's currency and period (left)."""
    r = rates.select("fiscper", F.col("currency").alias("__rate_currency"), "ActRate", "ACRate", "ActPYRate")
    return (df.join(r, (F.col("currency_copa") == F.col("__rate_currency")) & (F.col("period_year") == F.col("fiscper")), "left")
            .drop("fiscper", "__rate_currency"))


def convert_wide(wide: DataFrame, rates: DataFrame, keys: Sequence[str], measures: Sequence[str],
                 quantity_account: str = "VOLUME") -> DataFrame:
    """D6 (J12, A17, C16) on the wide table: local amounts at the actual, alternative and
    prior-year rate.  The currency is not a key of the result, quantities are not
    converted, NULL amounts give no row; the aggregate runs on the wide rows.

    Per key and measure: the sum of the measure and the largest rate over the rows
    where the measure is present; a (key, account) row exists iff some row has the
    measure.  ``explode`` then yields one row per account and, unlike an unpivot,
    keeps the hash partitioning of the aggregate, so a later rollup on a superset of
    the keys needs no new shuffle.  The shuffle carries the wide rows, not the
    seven-times larger long form.  The amounts are converted behind the ``explode``: one
    expression for all accounts, which the JVM compiles (one for each account is too long for it)."""
    joined = attach_rates(wide, rates)
    aggs = []
    for i, m in enumerate(measures):
        present = F.col(m).isNotNull()
        aggs.append(F.sum(m).alias(f"__s{i}"))
        aggs += [F.max(F.when(present, F.col(rate))).alias(f"__r{i}_{j}")
                 for j, rate in enumerate(("ActRate", "ACRate", "ActPYRate"))]
    g = joined.groupBy(*keys).agg(*aggs)

    names = ("amount_usd", "value_ac_rate", "value_py_rate")
    entries = [F.struct(F.lit(m).alias("account"), S.money(f"__s{i}").alias("amount_lcl"), F.col(f"__s{i}").cast("double").alias("__total"),
                        *[F.col(f"__r{i}_{j}").alias(f"__r{j}") for j in range(len(names))])
               for i, m in enumerate(measures)]
    rows = g.select(*keys, F.explode(F.array(*entries)).alias("__e")).where(F.col("__e.amount_lcl").isNotNull()).select(*keys, "__e.*")
    converted = F.col("account") != F.lit(quantity_account)
    quotients = rows.withColumns({f"__q{j}": F.when(converted, S.plain_divide("__total", f"__r{j}")) for j in range(len(names))})
    return quotients.select(*keys, "account", "amount_lcl",
                            *[F.when(converted, S.money_from_double(f"__q{j}")).otherwise(F.col("amount_lcl")).alias(n) for j, n in enumerate(names)])
