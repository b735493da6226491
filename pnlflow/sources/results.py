"""The result sink (S7): a result is replaced when all of the new one is there, or not at all.

1.  *Stage.*  The rows are written next to the target; the target itself, even if the job reads it,
    is untouched.
2.  *Check.*  What was staged is read back and must hold as many rows as were written, and the same
    exact sums.
3.  *Switch.*  A whole result changes places with the old one, which goes last.  A replacement of periods
    moves the checked rows of those periods in by Spark's dynamic partition overwrite.

A job that fails before the switch leaves the old result and removes what it staged.  One that dies between
the two renames of a switch leaves the old result beside the target; ``recover`` (run before each
replacement) puts it back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PERIOD_COLUMN = "PERIOD_YEAR"
_STAGED, _OLD = "__staged_", "__old_"


class CheckFailed(RuntimeError):
    """The staged rows are not those that were written."""


def _figures(df: DataFrame) -> list:
    """Rows, and an exact sum of a hash of every row: both are the same in any order of rows."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return [F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0).cast("decimal(38,0)")).alias("hashes")]


def _ordered(df: DataFrame) -> DataFrame:
    """Rebalanced by period (large periods are split, small ones share a task) and sorted by it within
    each file: files grow with the data, and a filter on the period skips row groups."""
    if PERIOD_COLUMN not in df.columns:
        return df
    return df.hint("rebalance", PERIOD_COLUMN).sortWithinPartitions(PERIOD_COLUMN)


class _Folder:
    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.target = spark, target.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def write(self, df: DataFrame, name: str) -> None:
        df.write.parquet(name)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(name)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def siblings(self, mark: str) -> list[str]:
        found = self.fs.globStatus(self.path(f"{self.target}{mark}*")) or []
        return sorted(str(s.getPath()) for s in found)


class _Table:
    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.target = spark, target
        *self.database, self.name = target.split(".")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.format("parquet").saveAsTable(name)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.table(name)

    def move(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def siblings(self, mark: str) -> list[str]:
        tables = self.spark.catalog.listTables(*([".".join(self.database)] if self.database else []))
        return sorted(".".join([*self.database, t.name]) for t in tables if t.name.startswith(f"{self.name}{mark}".lower()) or t.name.startswith(f"{self.name}{mark}"))


def _place(spark: SparkSession, target: str, as_table: bool) -> _Folder | _Table:
    return (_Table if as_table else _Folder)(spark, target)


def recover(spark: SparkSession, target: str, as_table: bool = False) -> None:
    """Finish what a dead run left: without a target its old result comes back; staged rows go."""
    place = _place(spark, target, as_table)
    for old in place.siblings(_OLD):
        if place.exists(target):
            place.drop(old)
        else:
            place.move(old, target)
    for staged in place.siblings(_STAGED):
        place.drop(staged)


def _stage(df: DataFrame, place: _Folder | _Table, staged: str) -> DataFrame:
    """Write the rows beside the target, and read them back checked."""
    seen = Observation()
    place.write(_ordered(df).observe(seen, *_figures(df)), staged)
    back = place.read(staged, df)
    found = back.agg(*_figures(back)).first().asDict()
    if found != seen.get:
        raise CheckFailed(f"{staged}: wrote {seen.get}, read {found}")
    return back


def replace_result(df: DataFrame, target: str, as_table: bool = False, before_switch: Callable[[DataFrame], None] | None = None) -> None:
    """Replace the whole result, a Parquet folder or a catalog table, in the order and types of its columns.
    ``before_switch`` sees the checked rows and may refuse them by raising."""
    spark = df.sparkSession
    place = _place(spark, target, as_table)
    recover(spark, target, as_table)
    run = uuid.uuid4().hex
    staged, old = f"{target.rstrip('/')}{_STAGED}{run}", f"{target.rstrip('/')}{_OLD}{run}"
    try:
        back = _stage(df, place, staged)
        if before_switch is not None:
            before_switch(back)
        had = place.exists(target)
        if had:
            place.move(target, old)
        try:
            place.move(staged, target)
        except BaseException:
            if had:
                place.move(old, target)
            raise
    except BaseException:
        place.drop(staged)
        raise
    if had:
        place.drop(old)
    if as_table:
        spark.catalog.refreshTable(target)
    else:
        spark.catalog.refreshByPath(target)


def replace_periods(df: DataFrame, target: str, before_switch: Callable[[DataFrame], None] | None = None) -> None:
    """Replace those periods that ``df`` holds, in a Parquet folder with one folder per period; others stay
    as they are.  A period that the run has no row of is not emptied."""
    spark = df.sparkSession
    place = _Folder(spark, target)
    recover(spark, target)
    staged = f"{place.target}{_STAGED}{uuid.uuid4().hex}"
    try:
        back = _stage(df, place, staged)
        if before_switch is not None:
            before_switch(back)
        # Spark moves the new folders in when all tasks are done; a failed job moves none
        (_ordered(back).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD_COLUMN).parquet(place.target))
    finally:
        place.drop(staged)
    spark.catalog.refreshByPath(target)


def read_periods(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """A result laid out by period, in the columns of ``like`` (the period is text, not a number)."""
    return spark.read.schema(like.schema).parquet(target).select(*like.columns)
