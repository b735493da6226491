"""Invariants of the allocation operators on random small frames (property tests)."""

from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pnlflow.functions import scalars as S
from pnlflow.operators import allocate, fx, reshape

DEC = "decimal(18,2)"
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

money = st.integers(min_value=-5000, max_value=5000).map(lambda c: D(c) / 100)
positive = st.integers(min_value=1, max_value=500).map(D)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), positive, money), min_size=1, max_size=12),
       pool=money)
def test_pool_spread_conserves_cost_plus_pool(spark, rows, pool):
    df = spark.createDataFrame([(f"p{p}", v, c) for p, v, c in rows], f"period string, vol {DEC}, cost {DEC}")
    pools = spark.createDataFrame([(f"p{p}", pool) for p in sorted({p for p, _, _ in rows})],
                                  f"period string, pool {DEC}")
    table = pools.join(allocate.period_total(df, "period", "vol", "total"), "period")
    out = allocate.spread_pool(df, table, "period", "vol", "cost", "pool", "total")
    got = out.agg(F.sum("cost")).first()[0]
    expected = sum(c for _, _, c in rows) + pool * len({p for p, _, _ in rows})
    assert abs(got - expected) <= D("0.00001") * len(rows)


# a nested hierarchy: sku -> ff -> bsp -> category
HIER = {"s1": ("f1", "b1", "c1"), "s2": ("f1", "b1", "c1"), "s3": ("f2", "b1", "c1"), "s4": ("f3", "b2", "c1"),
        "s5": ("f4", "b3", "c2"), "s6": ("f4", "b3", "c2")}


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(sorted(HIER)), st.integers(0, 40).map(D), money),
                     min_size=1, max_size=15))
def test_nested_cascade_conserves_cost(spark, rows):
    if sum(v for _, v, _ in rows) == 0:
        return  # a zero scope total loses the cost (documented precondition)
    df = spark.createDataFrame([(s, *HIER[s], "X", "p", v, c) for s, v, c in rows],
                               f"sku string, ff string, bsp string, category string, country string, "
                               f"period string, vol {DEC}, cost {DEC}")
    out = allocate.cascade_allocate(df, ["sku", "ff", "bsp", "category"], ["country", "period"], "vol", "cost", "adj")
    got = out.agg(F.sum("adj")).first()[0]
    assert abs(got - sum(c for _, _, c in rows)) <= D("0.00001") * len(rows)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-40, -1).map(D), money),
                     min_size=1, max_size=10))
def test_negative_proration_conserves_cost(spark, rows):
    df = spark.createDataFrame(rows, f"sku string, vol {DEC}, cost {DEC}")
    got = allocate.prorate_within(df, ["sku"], "vol", "cost", "adj").agg(F.sum("adj")).first()[0]
    assert abs(got - sum(c for _, _, c in rows)) <= D("0.00001") * len(rows)


@SETTINGS
@given(cells=st.dictionaries(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["A", "B", "C"])),
                             money, min_size=1, max_size=9))
def test_pivot_then_unpivot_is_identity_on_cells(spark, cells):
    df = spark.createDataFrame([(k, a, v) for (k, a), v in cells.items()], f"key string, account string, v {DEC}")
    wide = reshape.pivot_sum(df, ["key"], "account", "v", ["A", "B", "C"])
    back = reshape.unpivot_drop_nulls(wide, ["key"], ["A", "B", "C"], "account", "v")
    assert sorted((r["key"], r["account"], r["v"]) for r in back.collect()) == sorted(
        (k, a, v) for (k, a), v in cells.items())


@SETTINGS
@given(amounts=st.lists(money, min_size=1, max_size=6))
def test_volume_is_not_converted(spark, amounts):
    wide = spark.createDataFrame([("k", "CUR", "2023001", a) for a in amounts],
                                 f"key string, currency_copa string, period_year string, VOLUME {DEC}")
    rates = spark.createDataFrame([("2023001", "CUR", D("3"), D("7"), D("11"))],
                                  "fiscper string, currency string, ActRate decimal(18,6), ACRate decimal(18,6), "
                                  "ActPYRate decimal(18,6)")
    r = fx.convert_wide(wide, rates, ["key"], ["VOLUME"]).first()
    assert r["amount_usd"] == r["value_ac_rate"] == r["value_py_rate"] == r["amount_lcl"] == sum(amounts)


def test_sign_flag_with_a_hot_order_matches_window_reference(spark):
    """One order holds two thirds of all rows (and NULL orders form one more group):
    the aggregate + NULL-safe join flag equals the window definition, and the
    session lets AQE split the hot join partition."""
    from pyspark.sql import Window

    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    keyed = [("hot", D(1) if i % 3 else D(-1)) for i in range(2000)]
    keyed += [(f"o{i % 300}", D(-(i % 5)) + 2) for i in range(900)] + [(None, D(-1))] * 100
    rows = [(k, v, i) for i, (k, v) in enumerate(keyed)]
    df = spark.createDataFrame(rows, f"sales_order string, vol {DEC}, i int")
    got = {r["i"]: r["flag"] for r in allocate.net_sign_flag(df, ["sales_order"], "vol").collect()}
    w = Window.partitionBy("sales_order")
    ref = df.withColumn("flag", F.when(F.sum("vol").over(w) >= 0, "positive").otherwise("negative"))
    assert got == {r["i"]: r["flag"] for r in ref.collect()}


def convert_long(long_df, rates):
    """The definition: join the rates to every amount, then sum and divide by key and account."""
    joined = fx.attach_rates(long_df, rates)
    total = F.sum("amount")

    def at(rate):
        return F.when(F.col("account") != "VOLUME", S.money_from_double(S.plain_divide(total, F.max(rate)))).otherwise(S.money(total))

    return joined.groupBy("key", "account").agg(S.money(total).alias("amount_lcl"), at("ActRate").alias("amount_usd"),
                                                at("ACRate").alias("value_ac_rate"), at("ActPYRate").alias("value_py_rate"))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.sampled_from(["CUR", "OTH", "NONE"]),
                               st.one_of(st.none(), money), st.one_of(st.none(), money)),
                     min_size=1, max_size=8))
def test_wide_conversion_equals_unpivot_then_convert(spark, rows):
    wide = spark.createDataFrame(
        [(k, c, "2023001", a, b) for k, c, a, b in rows],
        f"key string, currency_copa string, period_year string, GROSS_SALES {DEC}, VOLUME {DEC}")
    rates = spark.createDataFrame([("2023001", "CUR", D("3"), D("7"), D("11")),
                                   ("2023001", "OTH", D("5"), D("2"), None)],
                                  "fiscper string, currency string, ActRate decimal(18,6), ACRate decimal(18,6), "
                                  "ActPYRate decimal(18,6)")
    measures = ["GROSS_SALES", "VOLUME"]
    long_df = reshape.unpivot_drop_nulls(wide, ["key", "currency_copa", "period_year"], measures, "account", "amount")
    cols = ["key", "account", "amount_lcl", "amount_usd", "value_ac_rate", "value_py_rate"]
    a = sorted(tuple(r) for r in convert_long(long_df, rates).select(*cols).collect())
    b = sorted(tuple(r) for r in fx.convert_wide(wide, rates, ["key"], measures).select(*cols).collect())
    assert a == b
