"""The result sink replaces all or nothing; scans read the months they need; figures are kept."""

import dataclasses
import datetime as dt
import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pnlflow.operators import allocate, enrich, levels
from pnlflow.plans.figures import Figures, NotConserved
from pnlflow.plans.pipeline import CASCADE_LEVELS, SCOPE, SIGN_GROUP, Stages
from pnlflow.rules import synthetic_params
from pnlflow.sources import layout, results
from pnlflow.sources.inputs import INPUT_NAMES, derived_inputs, read_inputs

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(str, df.collect()))


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, periods, n=20, amount="1.5"):
    return spark.range(n).select(F.concat(F.lit("SK"), F.col("id")).alias("SKU"), F.element_at(F.array(*map(F.lit, periods)), (F.col("id") % len(periods) + 1).cast("int")).alias("PERIOD_YEAR"),
                                 F.lit(amount).cast("double").alias("Value_LCL"))


@pytest.fixture(params=[False, True], ids=["folder", "table"])
def target(request, spark, tmp_path):
    name = "pnlflow_sink_test"
    yield (name, True) if request.param else (str(tmp_path / "result"), False)
    if request.param:
        for t in spark.catalog.listTables():
            if t.name.startswith(name):
                spark.sql(f"DROP TABLE {t.name}")


def read(spark, target):
    name, as_table = target
    return spark.read.table(name) if as_table else spark.read.parquet(name)


def leftovers(spark, target):
    place = results._place(spark, *target)
    return place.siblings("__staged_") + place.siblings("__old_")


# ---- replace ---------------------------------------------------------------------------

def test_replace_leaves_one_copy(spark, target):
    name, as_table = target
    for n in (20, 7):
        results.replace_result(frame(spark, ["1997001", "1997002"], n), name, as_table)
        assert rows(read(spark, target)) == rows(frame(spark, ["1997001", "1997002"], n)) and not leftovers(spark, target)


def test_a_job_that_fails_midway_leaves_the_old_result(spark, target):
    name, as_table = target
    old = frame(spark, ["1997001"])
    results.replace_result(old, name, as_table)
    late = F.when(F.col("SKU") == "SK19", F.raise_error(F.lit("no rate")).cast("double")).otherwise(F.col("Value_LCL"))
    with pytest.raises(Exception, match="no rate"):
        results.replace_result(old.repartition(4).withColumn("Value_LCL", late), name, as_table)
    assert rows(read(spark, target)) == rows(old) and not leftovers(spark, target)

    def refuse(_):
        raise NotConserved("cost lost")
    with pytest.raises(NotConserved):
        results.replace_result(frame(spark, ["1997009"]), name, as_table, refuse)
    assert rows(read(spark, target)) == rows(old) and not leftovers(spark, target)


def test_a_damaged_stage_is_not_switched_in(spark, target, monkeypatch):
    name, as_table = target
    old = frame(spark, ["1997001"])
    results.replace_result(old, name, as_table)
    place = results._Table if as_table else results._Folder
    real = place.read
    monkeypatch.setattr(place, "read", lambda self, staged, like: real(self, staged, like).where("SKU <> 'SK3'"))
    with pytest.raises(results.CheckFailed):
        results.replace_result(frame(spark, ["1997002"]), name, as_table)
    monkeypatch.undo()
    assert rows(read(spark, target)) == rows(old) and not leftovers(spark, target)


def test_a_switch_that_dies_between_its_renames_is_finished_later(spark, target, monkeypatch):
    name, as_table = target
    old = frame(spark, ["1997001"])
    results.replace_result(old, name, as_table)
    place = results._place(spark, name, as_table)
    place.move(name, f"{name}__old_dead")
    assert not place.exists(name)
    results.recover(spark, name, as_table)
    assert rows(read(spark, target)) == rows(old) and not leftovers(spark, target)
    # a rename that fails puts the old result back at once
    kind, real, calls = type(place), type(place).move, []

    def second_fails(self, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("store is down")
        return real(self, a, b)
    monkeypatch.setattr(kind, "move", second_fails)
    with pytest.raises(OSError, match="store is down"):
        results.replace_result(frame(spark, ["1997002"]), name, as_table)
    monkeypatch.undo()
    assert rows(read(spark, target)) == rows(old) and not leftovers(spark, target)


def test_the_target_may_be_an_input(spark, target):
    name, as_table = target
    results.replace_result(frame(spark, ["1997001"]), name, as_table)
    before = read(spark, target)
    results.replace_result(before.withColumn("Value_LCL", F.col("Value_LCL") * 2).unionByName(before), name, as_table)
    assert read(spark, target).agg(F.sum("Value_LCL")).first()[0] == 90.0


def test_only_the_periods_of_the_run_are_replaced(spark, tmp_path):
    path = str(tmp_path / "periods")
    first = frame(spark, ["1997001", "1997002", "1997003"], 30)
    results.replace_periods(first, path)
    assert rows(results.read_periods(spark, path, first)) == rows(first)
    again = frame(spark, ["1997002"], 4, "9.0")
    results.replace_periods(again, path)
    kept = first.where("PERIOD_YEAR <> '1997002'")
    assert rows(results.read_periods(spark, path, first)) == rows(kept) + rows(again)
    bad = again.repartition(2).withColumn("Value_LCL", F.when(F.col("SKU") == "SK3", F.raise_error(F.lit("no rate")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="no rate"):
        results.replace_periods(bad, path)
    assert rows(results.read_periods(spark, path, first)) == rows(kept) + rows(again) and not leftovers(spark, (path, False))
    # a run that reads the periods it replaces
    own = results.read_periods(spark, path, first).where("PERIOD_YEAR = '1997003'")
    results.replace_periods(own.withColumn("Value_LCL", F.lit(0.0)), path)
    assert results.read_periods(spark, path, first).where("PERIOD_YEAR = '1997003'").agg(F.sum("Value_LCL")).first()[0] == 0.0


# ---- facts by month --------------------------------------------------------------------

@pytest.fixture(scope="module")
def by_month(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("by_month")
    inputs = derived_inputs(spark, SF)
    for n in INPUT_NAMES:
        if n in layout.FACT_DATES:
            layout.write_by_period(getattr(inputs, n), layout.FACT_DATES[n], str(root / n))
        else:
            getattr(inputs, n).write.parquet(str(root / n))
    return read_inputs(spark, {n: str(root / n) for n in INPUT_NAMES}), root


def test_scans_read_the_months_of_the_run(spark, by_month):
    inputs, root = by_month
    p = synthetic_params()
    st = Stages(inputs, p)
    for df, name in ((st.ledger_base, "ledger_lines"), (st.reporting_extracts, "reporting_facts"), (st.planning_base, "planning_facts")):
        scan = next(line for line in plan(df).splitlines() if "FileScan parquet" in line and f"/{name}]" in line)
        assert "fact_period" in scan.split("PartitionFilters: [")[1].split("]")[0], scan

    def files(params):
        """How many files the run's window leaves to read."""
        window = layout.in_window(inputs.ledger_lines, params.period_start, params.period_end)
        return window.select(F.input_file_name()).distinct().count()

    wide = files(p)
    narrow = files(dataclasses.replace(p, period_end=dt.date(1997, 2, 28)))
    assert narrow == 2 and wide == 21  # one small file a month
    folders = [f for f in os.listdir(root / "ledger_lines") if f.startswith("fact_period=")]
    assert len(folders) > wide


def test_a_fact_by_month_gives_the_same_result(spark, by_month):
    want = Stages(derived_inputs(spark, SF), synthetic_params())
    got = Stages(by_month[0], synthetic_params())
    for stage in ("ledger_base", "reporting_extracts", "planning_base"):
        assert rows(getattr(got, stage)) == rows(getattr(want, stage))


def test_a_calendar_prunes_while_the_job_runs(spark, by_month, tmp_path):
    calendar = spark.createDataFrame([(1997 * 100 + m, f"1997Q{(m + 2) // 3}") for m in range(1, 13)], "fact_period int, quarter string")
    calendar.write.parquet(str(tmp_path / "calendar"))
    quarter = spark.read.parquet(str(tmp_path / "calendar")).where("quarter = '1997Q2'")
    some = layout.of_periods(by_month[0].ledger_lines, quarter)
    assert "dynamicpruning" in plan(some)
    assert rows(some.drop("fact_period")) == rows(by_month[0].ledger_lines.where("fact_period between 199704 and 199706").drop("fact_period"))


# ---- the sign table and the levels -----------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark):
    return Stages(derived_inputs(spark, SF), synthetic_params())


def exchanges(df):
    return [line for line in plan(df).splitlines() if " Exchange " in line or "-Exchange" in line or "Exchange hashpartitioning" in line]


def test_allocation_reads_the_sign_table_without_an_exchange(stages):
    (small, bounded), = stages.sign_table.positive
    (negative, _), = stages.sign_table.negative
    assert bounded and stages.sign_table.crowded is None
    cells = small.groupBy(*CASCADE_LEVELS, *SCOPE).agg(F.sum("volume_net"))
    prorated = allocate.prorate_within(negative, ["sku", *SCOPE], "volume_net", "cogs_manufacturing", "cost_share", True)
    for df in (cells, prorated, allocate.allocated_rollup(prorated), stages.positive_parts[0], allocate.allocated_rollup(stages.positive_parts[0])):
        text = plan(df)
        assert "Exchange hashpartitioning" not in text and text.count("FileScan") <= 2, text
    assert plan(prorated).count("FileScan parquet") == 1


def test_level_totals_take_two_exchanges_for_any_number_of_levels(stages):
    rows_ = stages.pool_spread
    for n in range(1, 5):
        totals = allocate.level_totals(rows_, CASCADE_LEVELS[:n], SCOPE, "volume_net", "cogs_manufacturing")
        assert plan(totals).count("Exchange hashpartitioning") == 2
    stored = [df for df, _ in stages.sign_table.positive]
    text = plan(allocate.level_totals(stored, CASCADE_LEVELS, SCOPE, "volume_net", "cogs_manufacturing"))
    assert text.count("Exchange hashpartitioning") == 1
    only_cost = plan(allocate.level_totals(stored, CASCADE_LEVELS, SCOPE, "volume_net", "cogs_manufacturing").select("__cost_0"))
    assert only_cost.count("Window [") == 1  # no volumes, no pass-ups


def test_windows_see_cells_or_counted_groups_only(stages):
    """No window over rows that are not bucketed by keys of counted size, or summed to cells."""
    for part in (*stages.positive_parts, *stages.negative_parts):
        for line in plan(part).splitlines():
            assert "Window" not in line or "sales_order" not in line


def test_crowded_groups_take_the_other_path(spark, stages):
    """With a limit of one row many groups are crowded: same flags, same totals, same shares; orders that are NULL
    and hold a third of the rows among them."""
    hot = stages.pool_spread.withColumn("sales_order", F.when(F.hash("customer", "sales_order") % 3 == 0, F.lit(None)).otherwise(F.col("sales_order")))
    plain = allocate.net_sign_flag(hot, SIGN_GROUP, "volume_net")
    for limit in (1, 0, None):
        table = allocate.sign_table(hot, SIGN_GROUP, ["sku", *SCOPE], "volume_net", limit)
        assert (table.crowded is None) == (limit is None)
        assert rows(table.rows.select(*plain.columns)) == rows(plain)
        parts = [df for df, _ in table.positive]
        factors = allocate.cascade_factors(parts, CASCADE_LEVELS, SCOPE, "volume_net", "cogs_manufacturing")
        got = allocate.union_all([allocate.apply_factors(df, factors, [*CASCADE_LEVELS, *SCOPE], "volume_net", "x") for df in parts]).select(*hot.columns, "x")
        low = allocate.union_all([allocate.prorate_within(df, ["sku", *SCOPE], "volume_net", "cogs_manufacturing", "x", b) for df, b in table.negative]).select(*hot.columns, "x")
        if limit == 1:
            want, want_low = rows(got), rows(low)
        assert rows(got) == want and rows(low) == want_low


def test_level_check(spark):
    data = [("a", "p", "x"), ("a", "p", "x"), ("b", "p", "x"), ("b", "q", "y"), ("c", None, "y"), ("c", "r", None), (None, "r", None)]
    df = spark.createDataFrame([(*r, "s", Decimal(1)) for r in data] + [("a", "z", "x", "t", Decimal(1))], "l0 string, l1 string, l2 string, s string, c decimal(9,2)")
    got = {r.child_level: tuple(r)[1:] for r in levels.level_check(df, ["l0", "l1", "l2"], ["s"], "c").collect()}
    assert got == {"l0": ("l1", 5, 2, Decimal(8), Decimal(4)), "l1": ("l2", 5, 0, Decimal(8), Decimal(0))}


# ---- figures ---------------------------------------------------------------------------

def test_figures_of_a_run(spark, tmp_path):
    figures = Figures()
    st = Stages(derived_inputs(spark, SF), synthetic_params(), figures)
    results.replace_result(st.result, str(tmp_path / "out"))
    found = {f.step: f for f in figures.report()}
    assert all(f.agrees for f in found.values()) and all(f.before != 0 for f in found.values()), list(map(str, found.values()))
    assert found["pool spread"].lost == pytest.approx(found["pool spread"].explained) and "without a cost" in str(found["pool spread"])
    joined = st.reconcile_delta  # the delta's own sums, over the stored inputs of the same stages
    assert found["delta booked"].after == joined.agg(F.sum(F.col("gross_sales") + F.col("g2n") + F.col("cogs_logistic") + F.col("cogs_manufacturing"))).first()[0]
    balance = levels.cost_balance(st.positive_allocated, SCOPE, "cogs_manufacturing", "cost_share").agg(F.sum("lost")).first()[0]
    assert found["positive rows allocated"].lost == balance
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(Stages(derived_inputs(spark, SF), synthetic_params()).result)
    assert Figures(wait=0.1).watch(joined, "pool", pool_cost="gross_sales") is not None


def test_a_step_that_loses_cost_is_found(spark, tmp_path, monkeypatch):
    real = enrich.orphan_totals
    monkeypatch.setattr(enrich, "orphan_totals", lambda flagged: real(flagged).withColumn("period_volume", (F.col("period_volume") * 2).cast("decimal(38,2)")))
    figures = Figures()
    st = Stages(derived_inputs(spark, SF), synthetic_params(), figures)
    results.replace_result(st.result, str(tmp_path / "out"))
    spread = next(f for f in figures.report() if f.step == "pool spread")
    assert not spread.agrees and "NOT CONSERVED" in str(spread)
    with pytest.raises(NotConserved, match="pool spread"):
        figures.report(strict=True)
