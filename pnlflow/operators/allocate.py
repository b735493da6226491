"""Cost allocation operators (D1-D4) and the allocated rollup.

The original job takes 17 group totals with ``SUM() OVER (PARTITION BY ...)`` over fact rows.
Here a window only ever sees groups of proven size: the rows of a (sku, country, period)
counted as small, which lie together in one bucketed table, or the allocation cells of one
country and period, of which there are as many as the catalogue has products.  Groups of rows
above ``CROWDED`` are totalled by aggregates that every map task pre-combines, and joined back
on NULL-safe keys, where AQE can split a hot key.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pnlflow.functions import scalars as S
from pnlflow.operators.joins import join_null_safe, stored, stored_by_key

POSITIVE, NEGATIVE = "positive", "negative"
#: Rows of one group that a task may hold; larger groups take the aggregate path.
CROWDED = 2_000_000


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def spread_pool(df: DataFrame, per_period: DataFrame, period: str, weight: str, target: str,
                pool_col: str, weight_total: str, parts: bool = False) -> DataFrame:
    """Spread a per-period pool over the rows of the period by their share of
    the period's weight:  target' = pool * weight / period_weight + target  when
    weight != 0, else target.  ``per_period`` has one row per period with the pool
    and the weight total; the join is inner: periods without a row disappear."""
    attached = attach_per_period(df, per_period.select(period, pool_col, weight_total), period)
    spread = (F.when(F.col(weight) != 0,
                     S.money_from_double(F.col(pool_col).cast("double") * S.safe_divide(weight, weight_total)
                                         + F.col(target).cast("double")))
              .otherwise(S.money(target)))
    if parts:
        share = S.money_from_double(F.col(pool_col).cast("double") * S.safe_divide(weight, weight_total))
        attached = attached.withColumns({"__before": S.money(target), "__share": F.when(F.col(weight) != 0, share)})
    return attached.withColumn(target, spread).drop(pool_col, weight_total)


def attach_per_period(df: DataFrame, table: DataFrame, period: str) -> DataFrame:
    """Attach a per-period table (inner: rows of periods without an entry vanish)."""
    return df.join(table, period, "inner")


def period_total(df: DataFrame, period: str, weight: str, out: str) -> DataFrame:
    """The weight total of each period."""
    return df.groupBy(period).agg(F.sum(weight).alias(out))


def net_sign_flag(df: DataFrame, group: Sequence[str], weight: str, flag: str = "flag") -> DataFrame:
    """Flag every row by the sign of its group's net weight: >= 0 positive,
    negative or NULL negative."""
    totals = df.groupBy(*group).agg(F.sum(weight).alias("__net"))
    return (join_null_safe(df, totals, group)
            .withColumn(flag, F.when(F.col("__net") >= 0, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE)))
            .drop("__net"))


@dataclasses.dataclass(frozen=True)
class SignTable:
    """The rows with the sign of their group, stored once.  ``small`` is bucketed by
    ``keys``: whatever groups by them or by more columns needs no exchange, and a group of
    ``keys`` has at most the counted number of rows.  ``crowded`` holds the other groups, if any;
    the two share no group."""

    small: DataFrame
    crowded: DataFrame | None
    keys: tuple[str, ...]

    def _of(self, sign: str) -> list[tuple[DataFrame, bool]]:
        return [(df.where(F.col("flag") == sign).drop("flag"), bounded)
                for df, bounded in ((self.small, True), (self.crowded, False)) if df is not None]

    @property
    def rows(self) -> DataFrame:
        return union_all([df for df in (self.small, self.crowded) if df is not None])

    @property
    def positive(self) -> list[tuple[DataFrame, bool]]:
        """(rows, whether groups of ``keys`` are bounded) of groups with a net weight >= 0."""
        return self._of(POSITIVE)

    @property
    def negative(self) -> list[tuple[DataFrame, bool]]:
        return self._of(NEGATIVE)


def sign_table(df: DataFrame, group: Sequence[str], keys: Sequence[str], weight: str, crowded: int | None = None,
               counted: DataFrame | None = None) -> SignTable:
    """Flag the rows of ``df`` by the sign of their ``group``'s net weight and store them by ``keys``,
    columns of ``group``.  The rows move once: the sign is taken in the partitioning they are
    stored in.  ``counted``: a table that holds at least the rows of each group of ``df``, if one is cheaper
    to count."""
    limit = CROWDED if crowded is None else crowded
    large = stored((df if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select(*keys, F.lit(True).alias("__large")))
    small, rest = df, None
    if not large.isEmpty():  # at most all rows / limit groups
        marked = join_null_safe(df, large, keys, "left")
        small, large_rows = marked.where("__large IS NULL").drop("__large"), marked.where("__large").drop("__large")
        rest = stored(net_sign_flag(large_rows, group, weight))
    net = F.sum(weight).over(Window.partitionBy(*group))
    flag = F.when(net >= 0, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))
    return SignTable(stored_by_key(small, keys, flag=flag), rest, tuple(keys))


def split_by_net_sign(df: DataFrame, group: Sequence[str], weight: str) -> tuple[DataFrame, DataFrame]:
    """D2 without a stored table: (rows of groups with net weight >= 0, all other rows)."""
    flagged = net_sign_flag(df, group, weight)
    return (flagged.where(F.col("flag") == POSITIVE).drop("flag"),
            flagged.where(F.col("flag") == NEGATIVE).drop("flag"))


def level_totals(parts: DataFrame | Sequence[DataFrame], levels: Sequence[str], scope: Sequence[str], weight: str,
                 cost: str, tasks: int | None = None) -> DataFrame:
    """Per allocation cell (all level keys + scope) the totals of every
    level the cell belongs to, and the cost passed up into each upper level.

    A row passes its cost from level lo to the next level hi iff the weight total
    of its lo group is 0 and that of its hi group is not.  Every condition
    depends only on the row's cell, so rows are summed to cells first, with map-side
    combine.  A cell's groups of all levels lie in its scope: dealt out by scope once,
    all totals of all levels are taken in that partitioning.  A scope has as many cells as the
    catalogue has products, however many rows there are.  Totals nobody selects are not
    computed.  ``parts`` share no cell.  ``tasks``: scopes are dealt to so many partitions, which are not
    put together again by their size (their sorts and windows all hold memory at once)."""
    parts = [parts] if isinstance(parts, DataFrame) else parts
    cells = union_all([df.groupBy(*levels, *scope).agg(F.sum(weight).alias("__w"), F.sum(cost).alias("__c")) for df in parts])
    groups = [Window.partitionBy(*scope, level) for level in levels] + [Window.partitionBy(*scope)]
    names = [f"__vol_{i}" for i in range(len(levels))] + ["__vol_scope"]
    out = cells.repartition(*([] if tasks is None else [tasks]), *scope).withColumns(
        {name: F.sum("__w").over(g) for name, g in zip(names, groups)} | {"__cost_0": F.sum("__c").over(groups[0])})
    passed = {f"__passed_{i}": F.sum(F.when((F.col(names[i - 1]) == 0) & (F.col(names[i]) != 0), F.col("__c")).otherwise(F.lit(0))).over(groups[i])
              for i in range(1, len(groups))}
    return out.withColumns(passed)


def attach_level_totals(parts: DataFrame | Sequence[DataFrame], levels: Sequence[str], scope: Sequence[str], weight: str, cost: str,
                        columns: Sequence[str]) -> DataFrame:
    """W2-W4 per row: join the chosen per-cell totals back to the rows."""
    parts = [parts] if isinstance(parts, DataFrame) else parts
    totals = level_totals(parts, levels, scope, weight, cost).select(*levels, *scope, *columns)
    return union_all([join_null_safe(df, totals, [*levels, *scope]) for df in parts])


def cascade_factors(parts: DataFrame | Sequence[DataFrame], levels: Sequence[str], scope: Sequence[str], weight: str, cost: str,
                    tasks: int | None = None) -> DataFrame:
    """D3 per cell: ``__f0`` = cost_0 / vol_0 and for upper levels ``__fk`` = passed_k / vol_k."""
    totals = level_totals(parts, levels, scope, weight, cost, tasks)
    upper = [(f"__passed_{k}", f"__vol_{k}" if k < len(levels) else "__vol_scope") for k in range(1, len(levels) + 1)]
    return totals.select(*levels, *scope, *[S.safe_divide(n, d).alias(f"__f{i}") for i, (n, d) in enumerate([("__cost_0", "__vol_0"), *upper])])


def apply_factors(df: DataFrame, factors: DataFrame, keys: Sequence[str], weight: str, out: str) -> DataFrame:
    """out = sum of weight * factor; a NULL factor makes the result NULL."""
    names = [c for c in factors.columns if c.startswith("__f")]
    amount = functools.reduce(Column.__add__, [F.col(weight).cast("double") * F.col(n) for n in names])
    return join_null_safe(df, factors, keys).withColumn(out, S.money_from_double(amount)).drop(*names)


def cascade_allocate(df: DataFrame, levels: Sequence[str], scope: Sequence[str], weight: str, cost: str,
                     out: str) -> DataFrame:
    """D3: proportional allocation with fallback up a hierarchy.

    out = w * cost_0 / vol_0  +  sum over upper levels k of  w * passed_k / vol_k
    (plain +: a NULL term, i.e. a zero level total, makes the result NULL).
    Precondition for conservation: every level total is >= 0 (use after
    ``split_by_net_sign``) and the levels are nested."""
    return apply_factors(df, cascade_factors(df, levels, scope, weight, cost), [*levels, *scope], weight, out)


def with_group_totals(df: DataFrame, group: Sequence[str], sums: dict[str, str], bounded: bool = False) -> DataFrame:
    """Every row with the sums of its group (column -> name of its sum).  ``bounded``: a group is
    known to be small, so its rows are totalled where they are."""
    if bounded:
        return df.withColumns({name: F.sum(c).over(Window.partitionBy(*group)) for c, name in sums.items()})
    totals = df.groupBy(*group).agg(*[F.sum(c).alias(name) for c, name in sums.items()])
    return join_null_safe(df, totals, group)


def prorate_within(df: DataFrame, group: Sequence[str], weight: str, cost: str, out: str, bounded: bool = False) -> DataFrame:
    """Single-level proration: out = group_cost * (weight / group_weight), no fallback."""
    return (with_group_totals(df, group, {weight: "__gw", cost: "__gc"}, bounded)
            .withColumn(out, S.money_from_double(F.col("__gc").cast("double") * S.safe_divide(weight, "__gw")))
            .drop("__gw", "__gc"))


ROLLUP_DIMS = ["category", "customer", "customer_name", "bsp", "brand", "ff", "sku", "country",
               "currency_copa", "period_year", "channel", "subchannel"]


def allocated_rollup(df: DataFrame, dims: Sequence[str] = ROLLUP_DIMS) -> DataFrame:
    """A8 + F10: drop the order grain, flip the gross-to-net sign, NULL allocation -> 0,
    keep a group if any of five aggregates is non-zero."""
    agg = (df.groupBy(*dims)
           .agg(F.sum("cogs_manufacturing").alias("cogs_manufacturing"),
                F.sum("cogs_logistic").alias("cogs_logistic"),
                S.negate(F.sum("g2n")).alias("g2n"),
                F.sum("gross_sales").alias("gross_sales"),
                F.sum("volume_net").alias("volume_net"),
                F.coalesce(F.sum("cost_share"), F.lit(0).cast(S.MONEY)).alias("cost_share")))
    return agg.where(any_nonzero(["gross_sales", "volume_net", "g2n", "cogs_logistic", "cost_share"]))


def any_nonzero(cols: Sequence[str]) -> Column:
    """OR of ``c != 0`` (NULL != 0 is not true)."""
    cond = None
    for c in cols:
        term = F.col(c) != 0
        cond = term if cond is None else cond | term
    return F.coalesce(cond, F.lit(False))
