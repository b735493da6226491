"""Pivot / unpivot with an explicit NULL policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """One column per label holding SUM(value); a key without a label gets NULL.
    Conditional sums in one aggregate (a generic pivot would take two)."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(label) == F.lit(x), F.col(value))).alias(x) for x in labels])


def pivot_sums(df: DataFrame, keys: Sequence[str], label: str, values: Mapping[str, str],
               labels: Sequence[str]) -> DataFrame:
    """As ``pivot_sum`` for several values (column -> suffix): columns label_suffix."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(label) == F.lit(x), F.col(v))).alias(f"{x}_{suffix}")
                                   for x in labels for v, suffix in values.items()])


def unpivot_drop_nulls(df: DataFrame, keys: Sequence[str], measures: Sequence[str], label: str,
                       value: str) -> DataFrame:
    """Measures -> (label, value) rows; labels are the column names, NULL
    values are dropped (SQL UNPIVOT semantics; DataFrame.unpivot keeps them)."""
    return (df.unpivot(list(keys), list(measures), label, value)
            .where(F.col(value).isNotNull()))
