"""Physical-plan checks: pushdown, pruning, broadcast dimensions, no Python, no hot-key windows."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import pnlflow.__main__ as job
from pnlflow import rules
from pnlflow.operators import enrich, fx, output
from pnlflow.plans.pipeline import Stages
from pnlflow.rules import synthetic_params
from pnlflow.sources.inputs import INPUT_NAMES, derived_inputs, read_inputs
from pnlflow.sources.results import replace_result
from pnlflow.sources.schemas import SCHEMAS, conform

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_inputs(spark, tmp_path_factory):
    """The derived inputs written as parquet tables, as production would read them."""
    root = tmp_path_factory.mktemp("inputs")
    inputs = derived_inputs(spark, SF)
    for n in INPUT_NAMES:
        getattr(inputs, n).write.mode("overwrite").parquet(str(root / n))
    return read_inputs(spark, {n: str(root / n) for n in INPUT_NAMES})


def test_ledger_filters_and_columns_reach_the_scan(stored_inputs):
    st = Stages(stored_inputs, synthetic_params())
    text = plan(st.ledger_base)
    scan = [line for line in text.splitlines() if "FileScan parquet" in line and "ledger_lines" in line][0]
    assert "PushedFilters" in scan
    for pushed in ("pstng_date", "comp_code", "indicator_b", "customer"):
        assert pushed in scan.split("PushedFilters")[1]
    assert "consumer_incentive" in scan  # used by A1
    pruned = plan(st.i.ledger_lines.select("fiscper", "gross"))
    assert "cost_man_1" not in pruned.split("ReadSchema")[1]


def test_small_dimensions_are_broadcast_and_no_python(stored_inputs):
    st = Stages(stored_inputs, synthetic_params())
    for df in (st.ledger_product_customer, enrich.attach_dimensions(st.ledger_conformed, st.product_dim, st.customer_dim)):
        joins = [line for line in plan(df).splitlines() if "Join" in line]
        assert len(joins) == 2 and all("BroadcastHashJoin" in j for j in joins), joins
    for df in (st.ledger_product_customer, st.reporting_measures, st.planning_enriched):
        t = plan(df)
        assert "PythonUDF" not in t and "EvalPython" not in t and "ArrowEvalPython" not in t


def rows(df):
    return Counter(map(str, df.collect()))


def test_dimensions_above_the_limit_are_not_broadcast(spark, stored_inputs):
    """With a limit that every dimension exceeds nothing is broadcast, and nothing changes."""
    names = ("orphan_sku", "orphan_customer", "ledger_product_customer", "result")
    want = {n: rows(getattr(Stages(stored_inputs, synthetic_params()), n)) for n in names}
    limits = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1"}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        st = Stages(stored_inputs, synthetic_params())
        for n in names:
            df = getattr(st, n)
            assert rows(df) == want[n]
            assert "Broadcast" not in plan(df), n
    finally:
        for k in limits:
            spark.conf.unset(k)


def scans(df, table):
    return sum("FileScan parquet" in line and f"/{table}]" in line for line in plan(df).splitlines())


def test_the_job_reads_each_fact_once(stored_inputs):
    st = Stages(stored_inputs, synthetic_params())
    assert scans(enrich.attach_dimensions(st.ledger_conformed, st.product_dim, st.customer_dim), "ledger_lines") == 1
    for df in (enrich.orphan_totals(st.flagged), st.pool_spread, st.positive_allocated, st.negative_allocated, st.actuals_customer, st.result):
        assert scans(df, "ledger_lines") == 0  # all of it comes from the stored rows
    assert scans(st.reporting_extracts, "reporting_facts") == 1
    assert scans(st.reporting_measures, "reporting_facts") == 1
    assert scans(st.planning_final, "planning_facts") == 2  # the net revenue rows; their shuffle is reused


def test_flagged_rows_hold_the_reported_stages(stored_inputs):
    st = Stages(stored_inputs, synthetic_params())
    matched = st.flagged.where("has_product").select(*st.ledger_product_customer.columns)
    assert rows(matched) == rows(st.ledger_product_customer)
    for part, stage in (("not has_product", st.orphan_sku), ("has_product and not has_customer", st.orphan_customer)):
        sums = st.flagged.where(part).groupBy("period_year", "sku").agg(*[F.sum(m).alias(m) for m in enrich.MEASURES])
        assert rows(sums.select(*[F.col(f.name).cast(f.dataType) for f in stage.schema])) == rows(stage)
    pool = st.period_totals.select("period_year", F.col("pool_cost").cast("decimal(38,2)"))
    assert rows(pool) == rows(st.orphan_pool.select("period_year", F.col("pool_cost").cast("decimal(38,2)")))


def test_pivot_and_conversion_need_one_shuffle(stored_inputs):
    st = Stages(stored_inputs, synthetic_params())
    keyed = [line for line in plan(st.reporting_measures).splitlines() if "Exchange hashpartitioning" in line]
    assert len(keyed) == 2, keyed  # the extract rollup and the pivot
    union = st.pnl_union
    before = plan(union).count("Exchange hashpartitioning")
    text = plan(output.pnl_wide(union))
    assert text.count("Exchange hashpartitioning") == before + 1
    assert plan(fx.convert_wide(output.pnl_wide(union), st.exchange_rates, output.FX_KEYS, list(rules.ACTUAL_MEASURES))).count(
        "Exchange hashpartitioning") == before + 1


@pytest.mark.parametrize("as_table", [False, True])
def test_result_round_trip(spark, stored_inputs, tmp_path, as_table):
    st = Stages(stored_inputs, synthetic_params())
    target = "pnlflow_result_test" if as_table else str(tmp_path / "result")
    for _ in range(2):  # replacing it leaves one copy
        replace_result(st.result, target, as_table)
    back = spark.read.table(target) if as_table else spark.read.parquet(target)
    assert back.dtypes == st.result.dtypes and back.columns == list(rules.OUTPUT_COLUMNS)
    assert rows(back) == rows(st.result)
    assert len(back.inputFiles()) <= 8  # by size, not by tasks times periods
    if as_table:
        spark.sql(f"DROP TABLE {target}")


def test_declared_schema_and_column_mapping(spark, tmp_path):
    source = spark.createDataFrame([(2024, "Jan", "Final", "UYU", "Act", 39.5, "Avg_Rate", "more")],
                                   "year int, period string, version string, currency string, scenario string, amount double, account string, x string")
    got = conform(source, "fx_rates", {"value": "amount"})
    assert got.dtypes == list(SCHEMAS["fx_rates"].items()) and got.first()["value"] == Decimal("39.5")
    with pytest.raises(ValueError, match="no column value"):
        conform(source, "fx_rates")


def test_job_from_the_command_line(spark, stored_inputs, tmp_path):
    p = synthetic_params()
    args = [f"--input={n}={d}" for n in INPUT_NAMES for d in getattr(stored_inputs, n).inputFiles()[:1]]
    args = [a.rsplit("/", 1)[0] for a in args]
    renamed = str(tmp_path / "rates")
    stored_inputs.fx_rates.withColumnRenamed("value", "amount").write.parquet(renamed)
    args = [f"--input=fx_rates={renamed}" if a.startswith("--input=fx_rates=") else a for a in args]
    accounts = str(tmp_path / "planning_accounts")
    stored_inputs.account_hier.where("false").write.parquet(accounts)
    run = [*args, "--column=fx_rates.value=amount", f"--target={tmp_path}/out", f"--period-start={p.period_start}", f"--period-end={p.period_end}",
           f"--reporting-start={p.reporting_start}", "--country-customers=" + ",".join(p.country_customers), "--rekey-skus=" + ",".join(p.rekey_skus),
           f"--rekey-customer={p.rekey_customer}"]
    job.main(run, spark)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows(out) == rows(Stages(stored_inputs, p).result)
    actuals = rows(out.where(F.col("SCENARIO") == rules.ACTUAL_SCENARIO))
    job.main([*run, f"--input=planning_account_hier={accounts}"], spark)  # planning has accounts of its own: none
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == actuals


def test_enrichment_rollups_reuse_the_conforming_shuffle(stored_inputs):
    """A3 and A5 group by supersets of A2's keys, so they run in A2's partitioning:
    the order-grain rows are shuffled twice (A1, A2), never by product / customer
    attributes."""
    st = Stages(stored_inputs, synthetic_params())
    text = plan(st.ledger_product_customer)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    fact_exchanges = [e for e in exchanges if "sku" in e]
    assert len(fact_exchanges) == 2, fact_exchanges
    assert not any("category" in e or "customer_name" in e for e in fact_exchanges)


def test_final_rollup_reuses_the_conversion_shuffle(stored_inputs):
    """The converted rows stay hash-partitioned by the conversion keys (explode keeps the
    partitioning), so the final rollup by those keys plus clusters and account adds no
    exchange keyed on the clusters."""
    st = Stages(stored_inputs, synthetic_params())
    text = plan(st.actuals_final)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("cluster1" in e or "cluster2" in e for e in exchanges), exchanges
