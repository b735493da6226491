"""What a dimension does to the rows that join it (J1, J5, J13, J16): key profiles, policies for
repeated keys, and the rows and amounts that a join multiplies."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Policy = Literal["keep", "first", "fail"]


def key_counts(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows each key has; a key with a NULL in it joins nothing and is left out."""
    return dim.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("rows_of_key"))


def key_profile(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: dim_rows, null_keys, distinct_keys, repeated_keys, most_rows (of one key)."""
    return (dim.groupBy(*keys).agg(F.count("*").alias("n"))
            .withColumn("known", ~F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dim_rows"), F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).alias("null_keys"),
                 F.count_if("known").alias("distinct_keys"), F.count_if(F.col("known") & (F.col("n") > 1)).alias("repeated_keys"),
                 F.coalesce(F.max(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("most_rows")))


def guarded(dim: DataFrame, keys: Sequence[str], policy: Policy = "keep") -> DataFrame:
    """The dimension as a join may use it.  ``keep``: as it is, a repeated key multiplies rows (what the
    original job does).  ``first``: one row of each key, the least in the order of the other columns (NULL
    first).  ``fail``: a repeated key is an error, found before the join."""
    if policy == "keep":
        return dim
    if policy == "first":
        rest = [c for c in dim.columns if c not in keys]
        least = dim.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
        return least.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in dim.columns])
    if policy == "fail":
        if worst := key_counts(dim, keys).where("rows_of_key > 1").orderBy(F.desc("rows_of_key"), *keys).first():
            raise ValueError(f"repeated key {', '.join(f'{k}={worst[k]}' for k in keys)}: {worst['rows_of_key']} rows")
        return dim
    raise ValueError(f"no such policy: {policy}")


def fan_out(fact: DataFrame, dim: DataFrame, on: dict[str, str], amount: str, name: str) -> DataFrame:
    """What a LEFT join of ``fact`` to ``dim`` does, without joining rows to rows: dimension, fact_rows,
    joined_rows, unmatched_rows, amount, joined_amount.  ``on``: fact column -> dimension column.  The fact is
    summed by its key first, so a hot key is one row."""
    by_key = fact.groupBy(*[F.col(f).alias(f"__{d}") for f, d in on.items()]).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    counts = key_counts(dim, list(on.values()))
    both = by_key.join(counts, [F.col(f"__{d}") == counts[d] for d in on.values()], "left")
    times = F.coalesce("rows_of_key", F.lit(1))
    zero = F.lit(0)
    return both.agg(F.coalesce(F.sum("n"), zero).alias("fact_rows"), F.coalesce(F.sum(F.col("n") * times), zero).alias("joined_rows"),
                    F.coalesce(F.sum(F.when(F.col("rows_of_key").isNull(), F.col("n"))), zero).alias("unmatched_rows"),
                    F.coalesce(F.sum("total"), zero).alias("amount"), F.coalesce(F.sum(F.col("total") * times), zero).alias("joined_amount")).select(
        F.lit(name).alias("dimension"), "*")
