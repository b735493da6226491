"""Allocation levels that are no hierarchy (D3): which levels split, and what that costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _value(c: str) -> Column:
    """The value as text, NULL being a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))


def level_check(df: DataFrame, levels: Sequence[str], scope: Sequence[str], cost: str) -> DataFrame:
    """Whether each level is nested in the next one, within ``scope``: child_level, parent_level, n_groups (of
    the child level), split_groups (that lie in several groups of the parent level), cost, split_cost.

    One pass for all levels: a group has one parent iff the least and the greatest parent agree, so rows
    are combined before they move and no parents are listed."""
    pairs = list(zip(levels, levels[1:]))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("child_level"), F.lit(p).alias("parent_level"), _value(c).alias("child"), _value(p).alias("parent"))
                               for c, p in pairs]))
    groups = (df.select(*scope, F.col(cost).alias("__cost"), each.alias("__pair")).select(*scope, "__cost", "__pair.*")
              .groupBy("child_level", "parent_level", *scope, "child")
              .agg(F.min("parent").alias("low"), F.max("parent").alias("high"), F.sum("__cost").alias("__cost")))
    split = F.col("low") != F.col("high")
    return (groups.groupBy("child_level", "parent_level")
            .agg(F.count("*").alias("n_groups"), F.count_if(split).alias("split_groups"), F.sum("__cost").alias("cost"),
                 F.coalesce(F.sum(F.when(split, F.col("__cost"))), F.lit(0)).alias("split_cost")))


def cost_balance(allocated: DataFrame, scope: Sequence[str], cost: str, share: str) -> DataFrame:
    """Per scope: n_rows, cost, allocated, unallocated_rows (whose share is NULL), lost (cost that no row
    bears; negative: cost that rows bear twice)."""
    totals = allocated.groupBy(*scope).agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(cost), F.lit(0)).alias("cost"),
                                           F.coalesce(F.sum(share), F.lit(0)).alias("allocated"), F.count_if(F.col(share).isNull()).alias("unallocated_rows"))
    return totals.withColumn("lost", F.col("cost") - F.col("allocated"))
