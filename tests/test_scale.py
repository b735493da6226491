"""What a task holds does not grow with the input: sized exchanges, no second rollup of the long rows, code that the JVM compiles."""

import math
import re
from collections import Counter
from decimal import Context

import pytest
from pyspark.sql import functions as F

from pnlflow.functions import scalars as S
from pnlflow.operators import allocate, joins, output
from pnlflow.plans.pipeline import CASCADE_LEVELS, SCOPE, Stages
from pnlflow.rules import synthetic_params
from pnlflow.sources.inputs import derived_inputs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def longest_method(df) -> int:
    """Bytes of the longest method that Spark generates for ``df`` (over 8,000 the JVM interprets it)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df.select("*")._jdf.queryExecution().executedPlan()))))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def stages(spark):
    return Stages(derived_inputs(spark, SF), synthetic_params())


def test_tasks_grow_with_the_files(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / f"a table {i}") for i in range(2)]
    for p in paths:
        spark.range(50_000).repartition(3).write.parquet(p)
    one, two = (spark.read.parquet(*paths[:n]) for n in (1, 2))
    monkeypatch.setattr(joins, "TASK_BYTES", 1_000)
    assert joins.tasks_for(one) > 3 * spark.sparkContext.defaultParallelism
    assert abs(joins.tasks_for(two) - 2 * joins.tasks_for(one)) <= 2
    assert joins.tasks_for(one, one.union(one)) == joins.tasks_for(one)  # each file once
    monkeypatch.setattr(joins, "MOST_TASKS", 20)
    assert joins.tasks_for(two) == 20
    assert joins.tasks_for(spark.range(5).toDF("x")) <= spark.sparkContext.defaultParallelism


def test_exchanges_are_sized_by_the_input(stages, monkeypatch):
    """A fixed number of partitions (or merged ones) made a task's hash tables grow with the facts."""
    monkeypatch.setattr(joins, "TASK_BYTES", 1_000)
    st = Stages(stages.i, stages.p)
    n, m = st.reporting_tasks, st.union_tasks
    assert m > n > 50
    wide = plan(st.reporting_wide)
    assert "hashpartitioning(extract" in wide and wide.count(f", {n}), REPARTITION_BY_NUM") == 2
    for df in (st.pnl_fx, st.pnl_long, st.actuals_final):
        assert f", {m}), REPARTITION_BY_NUM" in plan(df)
    totals = allocate.level_totals([df for df, _ in st.sign_table.positive], CASCADE_LEVELS, SCOPE, "volume_net", "cogs_manufacturing", m)
    assert f", {m}), REPARTITION_BY_NUM" in plan(totals)


def test_long_rows_are_not_rolled_up_again(stages):
    """partial and final hash tables over seven times the converted rows stood in one task."""
    text = plan(stages.actuals_final)
    assert not any("HashAggregate" in line and "account#" in line and "customer_name#" in line for line in text.splitlines())


def test_repeated_clusters_count_as_often_as_in_the_rollup(spark, stages):
    """Copies of a cluster row multiply the amounts; two clusters of a country give two rows; a country without gives NULLs."""
    keys = [F.lit("k").alias(k) for k in output.FX_KEYS if k not in ("country", "sku")]
    amount = F.col("x").cast("decimal(38,6)")
    rows = spark.createDataFrame([("S1", "URUGUAY", "G2N", "1.250001"), ("S2", "CHILE", "G2N", "-7"), ("S3", None, "VOLUME", "3"), ("S1", "URUGUAY", "VOLUME", None)],
                                 "sku string, country string, account string, x string").withColumn("x", amount)
    converted = rows.select("sku", "country", *keys, "account", F.col("x").alias("amount_lcl"), (F.col("x") * 2).cast("decimal(38,6)").alias("amount_usd"),
                            F.lit(None).cast("decimal(38,6)").alias("value_ac_rate"), F.col("x").alias("value_py_rate")).withColumn("period_year", F.lit("1997001"))
    entity = stages.p.entity
    clusters = spark.createDataFrame([("Uruguay", "A", "B", entity)] * 3 + [("uruguay", "A", None, entity), ("Chile", "A", "B", "other")],
                                     "country string, cluster1 string, cluster2 string, fit_entity string")
    want, got = (Counter(map(str, output.actuals_final(converted, clusters, stages.p, unique=u).collect())) for u in (False, True))
    assert want == got and sum(got.values()) == 6 and any("Value_LCL=3.750003" in r for r in got)


def test_conversion_is_compiled(stages):
    """All accounts and rates converted in one expression each made a method that the JVM only interprets."""
    for df in (stages.pnl_fx, stages.actuals_final):
        assert longest_method(df) < 8_000


def test_money_of_any_size(spark):
    """Both ways of rounding meet without a step; the digits are those of floor(x * 1e6 + 0.5)."""
    xs = [0.0, -0.0000005, 1.2345675, -1.2345675, 4.6e12, -4.6e12, 4.7e12, -4.7e12, 123456789012345.67, -9.9e23, None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(S.money_from_double("x")).collect()]
    assert [None if y is None else int(y.scaleb(6, Context(prec=50))) for y in got] == [None if x is None else math.floor(x * 1e6 + 0.5) for x in xs]
    with pytest.raises(Exception, match="money limit"):
        spark.createDataFrame([(1.1e24,)], "x double").select(S.money_from_double("x")).collect()
