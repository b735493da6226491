"""Code tables (C3) as data: code -> label with a version, from ``rules`` or from a file."""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pnlflow.functions import scalars as S


@dataclasses.dataclass(frozen=True)
class CodeTable:
    """A small table of codes.  Each code has one label; a code given twice is an error."""

    name: str
    labels: Mapping[str, str]
    version: str = "fixed"

    @classmethod
    def of(cls, name: str, pairs: Iterable[tuple[str, str]], version: str = "fixed") -> CodeTable:
        pairs = list(pairs)
        if twice := sorted(c for c, n in Counter(c for c, _ in pairs).items() if n > 1):
            raise ValueError(f"{name} {version}: more than one label for {', '.join(map(str, twice))}")
        if any(c is None for c, _ in pairs):
            raise ValueError(f"{name} {version}: a label without a code")
        return cls(name, dict(pairs), version)

    @classmethod
    def read(cls, spark: SparkSession, path: str, name: str, version: str | None = None, fmt: str = "csv", most: int = 10_000) -> CodeTable:
        """From a file with the columns code, label and, if it holds several versions, version (default: the
        greatest).  A file of more than ``most`` rows is no code table but a dimension: an error."""
        reader = spark.read.format(fmt)
        df = (reader.option("header", True) if fmt == "csv" else reader).load(path)
        if "version" in df.columns:
            if version is None:
                version = df.agg(F.max(F.col("version").cast("string"))).first()[0]
            df = df.where(F.col("version").cast("string") == F.lit(version))
        rows = df.select(F.col("code").cast("string"), F.col("label").cast("string")).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{path}: more than {most} codes")
        return cls.of(name, [tuple(r) for r in rows], version or "fixed")

    def label(self, c: str | Column, default: Column | None = None) -> Column:
        """The label of a code; unknown and NULL codes: ``default``, else NULL."""
        if not self.labels:
            return F.lit(None).cast("string") if default is None else default
        return S.label(c, self.labels, default)

    def unmapped(self, df: DataFrame, c: str) -> DataFrame:
        """The codes of a column that have no label: code_table, code, n_rows.  NULL is no code."""
        return (df.where(F.col(c).isNotNull() & ~F.col(c).isin(*self.labels)).groupBy(F.col(c).cast("string").alias("code")).agg(F.count("*").alias("n_rows"))
                .select(F.lit(self.name).alias("code_table"), "code", "n_rows"))
