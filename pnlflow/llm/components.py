"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the same key, so a node with a huge
neighbourhood is pre-aggregated before the shuffle and its join partition can be split
at run time.  Every round is stored in the shared checkpoint folder; nothing but two
numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a > b").distinct())
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    return (large.join(small, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a > b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node -> smallest node of its component, for every node that is not the smallest itself.

    edges: two long columns; loops, repeats and both directions may occur."""
    a, b = edges.columns[:2]
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    seen = mark(now)
    while seen[0]:
        now = stored(_stars(now), "edges")
        then, seen = seen, mark(now)
        if then == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
