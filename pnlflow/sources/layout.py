"""Facts laid out by month, and scans that read only the months they need.

A fact written by ``write_by_period`` is a folder per ``fact_period`` (year * 100 + month of its date;
rows without a date lie in a folder of their own that no run reads).  ``in_window`` turns the dates of a
run into a filter on that column, next to the exact filter on the date; a fact without the
column is read as before."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = "fact_period"
#: The date that places a row of each fact.
FACT_DATES = {"ledger_lines": "pstng_date", "reporting_facts": "date", "planning_facts": "date"}


def period_number(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def write_by_period(fact: DataFrame, date: str, path: str, mode: str = "errorifexists") -> None:
    """Write a fact by month.  Months are rebalanced by size, so a large month is many files and a
    small one a single file; within a file rows lie in the order of their date."""
    placed = fact.withColumn(PERIOD, period_number(F.col(date)))
    placed.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, date).write.mode(mode).partitionBy(PERIOD).parquet(path)


def in_window(fact: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Only the months from ``first`` to ``last`` (None: open), if the fact is laid out by month."""
    if PERIOD not in fact.columns:
        return fact
    if first is not None:
        fact = fact.where(F.col(PERIOD) >= first.year * 100 + first.month)
    if last is not None:
        fact = fact.where(F.col(PERIOD) <= last.year * 100 + last.month)
    return fact


def of_periods(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """The rows of the months of ``calendar`` (a dimension with ``fact_period``, filtered as needed: a quarter,
    the months still open).  The join prunes the fact's folders while the job runs."""
    return fact.join(calendar.select(PERIOD).distinct(), PERIOD)
