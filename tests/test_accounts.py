"""Accounts as formulas, code tables, and what dimensions do to the rows that join them."""

from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from pnlflow.functions.codes import CodeTable
from pnlflow.operators import guard, reshape
from pnlflow.operators.accounts import Formula, base_accounts, derive_long, evaluate, job_formulas, ordered

FORMULAS = [Formula("GP", {"NR": 1, "CM": -1}), Formula("NR", {"GS": 1, "G2N": -1}), Formula("ANY", {"GS": 1, "CM": 1}, "zero")]


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_formulas_are_ordered_by_what_they_use(spark):
    assert [f.name for f in ordered(FORMULAS)].index("NR") < [f.name for f in ordered(FORMULAS)].index("GP")
    assert sorted(base_accounts(FORMULAS)) == ["CM", "G2N", "GS"]
    with pytest.raises(ValueError, match="depend on each other"):
        ordered([Formula("A", {"B": 1}), Formula("B", {"A": 1})])
    with pytest.raises(ValueError, match="two formulas"):
        ordered([FORMULAS[0], FORMULAS[0]])
    with pytest.raises(ValueError, match="no account CM"):
        evaluate(FORMULAS, {"GS": F.lit(1), "G2N": F.lit(1)})


def test_signs_of_the_result():
    shown = {f.name: dict(f.parts) for f in job_formulas("null", shown=True, lower=True)}
    assert shown == {"net_revenue": {"gross_sales": 1, "g2n": -1}, "gross_profit": {"net_revenue": 1, "cogs_manufacturing": -1, "cogs_logistic": -1}}


@pytest.fixture(scope="module")
def lines(spark):
    data = [("a", "GS", 10, 1), ("a", "GS", 5, None), ("a", "G2N", 3, 2), ("a", "CM", 4, None), ("a", "OTHER", 99, 99),
            ("b", "GS", 7, None), ("b", "CM", 2, 1), (None, "GS", 1, 1), (None, "G2N", 1, 1), ("c", "OTHER", 5, 5)]
    return spark.createDataFrame([(k, a, None if x is None else D(x), None if y is None else D(y)) for k, a, x, y in data],
                                 "k string, account string, x decimal(18,2), y decimal(18,2)")


def test_derived_rows(lines):
    got = {(r.k, r.account): (r.x, r.y) for r in derive_long(lines, ["k"], "account", ["x", "y"], FORMULAS).collect()}
    assert got == {("a", "NR"): (12, -1), ("a", "GP"): (8, 0), ("a", "ANY"): (19, 1), ("b", "ANY"): (9, 1), (None, "NR"): (0, 0), (None, "ANY"): (1, 1),
                   ("c", "ANY"): (0, 0)}
    only = derive_long(lines, ["k"], "account", ["x"], FORMULAS, keep=["GP"])
    assert rows(only) == Counter({("a", "GP", D(8)): 1})


def test_the_long_pivot_chain_agrees(lines):
    """Pivot, derive, unpivot, filter: three shuffles' worth of notation for the one aggregate."""
    pivoted = reshape.pivot_sums(lines, ["k"], "account", {"x": "x"}, ["GS", "G2N", "CM"])
    wide = pivoted.withColumns(evaluate(FORMULAS[:2], {a: F.col(f"{a}_x") for a in ("GS", "G2N", "CM")}))
    chain = reshape.unpivot_drop_nulls(wide.select("k", "GP", "NR"), ["k"], ["GP", "NR"], "account", "x")
    assert rows(chain) == rows(derive_long(lines, ["k"], "account", ["x"], FORMULAS[:2]))
    plan = derive_long(lines, ["k"], "account", ["x", "y"], FORMULAS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# ---- code tables -----------------------------------------------------------------------

def test_code_table_from_a_file(spark, tmp_path):
    path = str(tmp_path / "codes")
    spark.createDataFrame([("A", "old", "1"), ("A", "new", "2"), ("B", "b", "2")], "code string, label string, version string").coalesce(1).write.option(
        "header", True).csv(path)
    latest, first = CodeTable.read(spark, path, "t"), CodeTable.read(spark, path, "t", version="1")
    assert (latest.labels, latest.version) == ({"A": "new", "B": "b"}, "2") and first.labels == {"A": "old"}
    with pytest.raises(ValueError, match="more than 1 codes"):
        CodeTable.read(spark, path, "t", most=1)
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("C",), (None,)], "c string")
    assert [r[0] for r in df.select(latest.label("c", F.lit("?"))).collect()] == ["new", "b", "?", "?", "?"]
    assert [r[0] for r in df.select(latest.label("c")).collect()] == ["new", "b", None, None, None]
    assert rows(latest.unmapped(df, "c")) == Counter({("t", "C", 2): 1})
    assert df.select(CodeTable("none", {}).label("c")).distinct().collect()[0][0] is None


def test_a_code_has_one_label():
    with pytest.raises(ValueError, match="more than one label for A"):
        CodeTable.of("t", [("A", "x"), ("A", "x")])
    with pytest.raises(ValueError, match="without a code"):
        CodeTable.of("t", [(None, "x")])


# ---- repeated keys ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("b", 5, None), (None, 0, "n"), (None, 1, "n")], "k string, n int, s string")


def test_key_profile(dim):
    assert guard.key_profile(dim, ["k"]).first().asDict() == {"dim_rows": 5, "null_keys": 2, "distinct_keys": 2, "repeated_keys": 1, "most_rows": 2}
    assert guard.key_profile(dim.limit(0), ["k"]).first().asDict() == {"dim_rows": 0, "null_keys": 0, "distinct_keys": 0, "repeated_keys": 0, "most_rows": 0}


def test_policies(dim):
    assert rows(guard.guarded(dim, ["k"])) == rows(dim)
    assert rows(guard.guarded(dim, ["k"], "first")) == Counter([("a", 1, "z"), ("b", 5, None), (None, 0, "n")])
    with pytest.raises(ValueError, match="k=a: 2 rows"):
        guard.guarded(dim, ["k"], "fail")
    assert guard.guarded(dim.where("k = 'b'"), ["k"], "fail").count() == 1
    with pytest.raises(ValueError, match="no such policy"):
        guard.guarded(dim, ["k"], "any")


def test_fan_out_equals_the_join(spark, dim):
    fact = spark.createDataFrame([("a", D(1)), ("a", D(2)), ("b", D(4)), ("c", D(8)), (None, D(16))], "f string, v decimal(10,2)")
    got = guard.fan_out(fact, dim, {"f": "k"}, "v", "d").first()
    joined = fact.join(dim, fact["f"] == dim["k"], "left")
    assert tuple(got) == ("d", 5, joined.count(), 2, D(31), joined.agg(F.sum("v")).first()[0])
    assert tuple(guard.fan_out(fact.limit(0), dim, {"f": "k"}, "v", "d").first())[1:] == (0, 0, 0, 0, 0)
