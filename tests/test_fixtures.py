"""Hand-worked cases of FIXTURES.md (G1-G9) on tiny frames."""

import datetime as dt
from decimal import Decimal as D, localcontext

import pytest
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.operators import allocate, fx, ledger, planning, reconcile, reshape
from pnlflow.rules import JobParams

DEC = "decimal(18,2)"


def _dec(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_g1_key_cleaning(spark):
    p = JobParams(rekey_skus=("123",), rekey_customer="999")
    base = spark.createDataFrame(
        [("2023001", "0000000123", "0000456", "1"), ("2023001", "0000", None, "2"),
         ("2023001", None, "0000456", "3"), ("2023001", "0000000123", "#", "4")],
        "fiscper string, material string, customer string, doc_number string")
    stripped = base.select("fiscper", ledger.S.strip_zeros_trim("material").alias("sku"), "customer", "doc_number",
                           F.lit("UYU").alias("currency_copa"))
    out = {r["sales_order"]: (r["customer"], r["sku"]) for r in
           stripped.select(*ledger.conformed_keys(p)).collect()}
    assert out["1"] == ("456", "SK123")
    assert out["2"] == ("#", "SK")
    assert out["3"] == ("456", "001")
    assert out["4"] == ("999", "SK123")


def test_g2_pool_spread(spark):
    rows = spark.createDataFrame(
        [("p1", D("10"), D("1")), ("p1", D("30"), D("2")), ("p1", D("0"), D("3")), ("p1", None, D("4")),
         ("p2", D("5"), D("5"))],
        f"period string, vol {DEC}, cost {DEC}")
    pool = spark.createDataFrame([("p1", D("50"))], f"period string, pool {DEC}")
    table = pool.join(allocate.period_total(rows, "period", "vol", "total"), "period")
    out = allocate.spread_pool(rows, table, "period", "vol", "cost", "pool", "total").collect()
    got = sorted(float(r["cost"]) for r in out)
    assert got == [3.0, 4.0, 13.5, 39.5]  # the period without a pool row vanishes
    assert sum(got) == 60.0


def test_g3_sign_split(spark):
    df = spark.createDataFrame(
        [("a", D("5")), ("a", D("-5")), ("b", D("2")), ("b", D("-3")), ("c", None)], f"g string, vol {DEC}")
    pos, neg = allocate.split_by_net_sign(df, ["g"], "vol")
    assert sorted({r["g"] for r in pos.collect()}) == ["a"]
    assert sorted({r["g"] for r in neg.collect()}) == ["b", "c"]


def test_g4_cascade(spark):
    data = [("s1", "f1", "b1", "c1", 10, 100), ("s1", "f1", "b1", "c1", 30, 60), ("s2", "f1", "b1", "c1", 5, 7),
            ("s2", "f1", "b1", "c1", -5, 1), ("s3", "f2", "b1", "c1", 0, 12), ("s4", "f3", "b2", "c1", 0, 20),
            ("s5", "f4", "b3", "c2", 0, 40), ("s7", None, "b1", "c1", 0, 0)]
    df = spark.createDataFrame(
        [(s, f, b, c, "X", "p", D(v), D(k)) for s, f, b, c, v, k in data],
        f"sku string, ff string, bsp string, category string, country string, period string, vol {DEC}, cost {DEC}")
    out = allocate.cascade_allocate(df, ["sku", "ff", "bsp", "category"], ["country", "period"], "vol", "cost",
                                    "adj").collect()
    adj = sorted((r["sku"], float(r["vol"]), r["adj"]) for r in out)
    assert adj[0] == ("s1", 10.0, D("60.000000"))
    assert adj[1] == ("s1", 30.0, D("180.000000"))
    assert all(a is None for _, _, a in adj[2:])
    assert sum(a for _, _, a in adj if a is not None) == D("240")


def test_g5_negative_prorate(spark):
    df = spark.createDataFrame([("s", D("-4"), D("-10")), ("s", D("-6"), D("30")), ("t", None, D("5"))],
                               f"sku string, vol {DEC}, cost {DEC}")
    out = {(r["sku"], r["vol"]): r["adj"] for r in allocate.prorate_within(df, ["sku"], "vol", "cost", "adj").collect()}
    assert out[("s", D("-4.00"))] == D("8.000000")
    assert out[("s", D("-6.00"))] == D("12.000000")
    assert out[("t", None)] is None


def test_g6_pivot_and_unpivot(spark):
    labels = ["A", "B", "C"]
    long_df = spark.createDataFrame([("one", "A", D("5")), ("one", "A", D("2")), ("none", "B", None), ("none", "X", D("9"))],
                                    f"key string, account string, v {DEC}")
    wide = {r["key"]: tuple(r)[1:] for r in reshape.pivot_sum(long_df, ["key"], "account", "v", labels).collect()}
    assert wide == {"one": (D("7"), None, None), "none": (None, None, None)}
    back = reshape.unpivot_drop_nulls(reshape.pivot_sum(long_df, ["key"], "account", "v", labels), ["key"], labels, "account", "v")
    assert [tuple(r) for r in back.collect()] == [("one", "A", D("7"))]
    two = reshape.pivot_sums(long_df.withColumn("w", F.lit(1)), ["key"], "account", {"v": "v", "w": "n"}, labels)
    assert two.columns == ["key", "A_v", "A_n", "B_v", "B_n", "C_v", "C_n"]
    assert {r["key"]: (r["A_v"], r["A_n"], r["B_n"], r["C_n"]) for r in two.collect()} == {
        "one": (D("7"), 2, None, None), "none": (None, None, 1, None)}


LARGE = [D("50000000000000"), D("-50000000000000"), D("9300000000000.5"), D("0.0000005"), D("-0.0000005"), D("123456789012345678.25")]


def test_large_amounts_are_exact(spark):
    """D1, D3, D4 and D6 on amounts whose micros exceed 64 bits."""
    amount = "decimal(38,2)"
    for x in LARGE[:2] + [D("9300000000000"), D("2") ** 60]:
        one = spark.createDataFrame([("s", "p", D("1"), x)], f"sku string, period string, vol {amount}, cost {amount}")
        table = spark.createDataFrame([("p", x, D("1"))], f"period string, pool {amount}, total {amount}")
        spread = allocate.spread_pool(one.withColumn("cost", F.lit(D("0")).cast(amount)), table, "period", "vol", "cost", "pool", "total")
        assert spread.first()["cost"] == x
        assert allocate.cascade_allocate(one, ["sku"], ["period"], "vol", "cost", "adj").first()["adj"] == x
        assert allocate.prorate_within(one, ["sku"], "vol", "cost", "adj").first()["adj"] == x
        wide = spark.createDataFrame([("k", "CUR", "1997003", x)], f"key string, currency_copa string, period_year string, G2N {amount}")
        rates = spark.createDataFrame([("1997003", "CUR", D("1"), D("1"), D("1"))], "fiscper string, currency string, "
                                      "ActRate decimal(18,6), ACRate decimal(18,6), ActPYRate decimal(18,6)")
        assert fx.convert_wide(wide, rates, ["key"], ["G2N"]).first()["amount_usd"] == x


def test_money_rounding_has_no_cap(spark):
    import math

    from pnlflow.functions import scalars as S

    values = [float(x) for x in LARGE] + [9.3e12, 5e13, -5e13, 1.5e18, -1e23, 0.0, -0.0, 1e-7, 2.5e-6, -2.5e-6, 1234.5678905,
                                          -51015.131562500006, -1.0000004999999999, -5e-7, -1e-7, -123456789.0123455]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(S.money_from_double("v")).collect()]
    with localcontext(prec=60):
        assert got == [D(math.floor(v * 1000000.0 + 0.5)).scaleb(-6) for v in values]
    with pytest.raises(Exception, match="money limit"):
        spark.createDataFrame([(1e25,)], "v double").select(S.money_from_double("v")).collect()


def test_g7_fx(spark):
    wide = spark.createDataFrame(
        [("k", "CUR", "1997003", D("400"), D("400"), None), ("k", "XXX", "1997003", None, None, D("400"))],
        f"key string, currency_copa string, period_year string, GROSS_SALES {DEC}, VOLUME {DEC}, G2N {DEC}")
    rates = spark.createDataFrame([("1997003", "CUR", D("40"), D("50"), D("20"))],
                                  "fiscper string, currency string, ActRate decimal(18,6), ACRate decimal(18,6), "
                                  "ActPYRate decimal(18,6)")
    out = {r["account"]: r for r in fx.convert_wide(wide, rates, ["key"], ["GROSS_SALES", "VOLUME", "G2N"]).collect()}
    g = out["GROSS_SALES"]
    assert (g["amount_usd"], g["value_ac_rate"], g["value_py_rate"]) == (D("10"), D("8"), D("20"))
    v = out["VOLUME"]
    assert (v["amount_usd"], v["value_ac_rate"], v["value_py_rate"]) == (D("400"), D("400"), D("400"))
    assert out["G2N"]["amount_usd"] is None  # no rate for that currency / period


def test_g7_prior_year_rate(spark):
    rates = spark.createDataFrame(
        [(2023, "Mar", "Final", "CUR", "Act", D("20"), "Avg_Rate"),
         (2024, "Mar", "Final", "CUR", "Act", D("40"), "Avg_Rate"),
         (2024, "Mar", "Final", "CUR", "AC", D("50"), "Avg_Rate"),
         (2024, "Xyz", "Final", "CUR", "Act", D("1"), "Avg_Rate")],
        "year int, period string, version string, currency string, scenario string, value decimal(18,6), "
        "account string")
    p = JobParams(period_start=dt.date(2024, 1, 1), period_end=dt.date(2024, 12, 31))
    out = {r["fiscper"]: r for r in fx.exchange_rates(rates, p).collect()}
    assert set(out) == {"2024003"}  # the unknown month label has no date and falls out of the window
    r = out["2024003"]
    assert (r["ActRate"], r["ACRate"], r["ActPYRate"]) == (D("40"), D("50"), D("20"))


def test_g8_delta(spark):
    rep = spark.createDataFrame(
        [(sku, "p", "UY", D("100"), D("0"), D("100"), D("0"), D("0"), D("0"), D("0")) for sku in ("a", "b", "d")],
        f"sku string, period_year string, country string, cogs_manufacturing {DEC}, cogs_logistic {DEC}, "
        f"gross_sales {DEC}, g2n {DEC}, volume {DEC}, net_revenue {DEC}, gross_profit {DEC}")
    act = spark.createDataFrame(
        [("a", "p", "C", "x", "y", "z", "w", D("80")), ("c", "p", "C", "x", "y", "z", "w", D("80")),
         ("d", "p", "C", "x1", "y", "z", "w", D("80")), ("d", "p", "C", "x2", "y", "z", "w", D("10"))],
        f"sku string, period_year string, currency_copa string, bsp string, brand string, category string, "
        f"ff string, gross_sales {DEC}")
    act = act.select("*", *[F.lit(D("0")).cast(DEC).alias(c) for c in
                            ("cost_share", "cogs_logistic", "g2n", "volume_net")])
    out = sorted((r["sku"], r["bsp"], float(r["gross_sales"])) for r in reconcile.reconcile_delta(rep, act).collect())
    assert out == [("a", "x", 20.0), ("b", None, 100.0), ("d", "x1", 20.0), ("d", "x2", 90.0)]


def test_g9_planning_net_revenue(spark):
    keys = {k: "k" for k in planning.ENRICHED_KEYS if k not in ("cuenta", "date")}
    rows = [
        {**keys, "sku": "s1", "date": dt.date(2023, 1, 1), "cuenta": "GROSS_SALES", "value_lcl": D("100"),
         "value_usd": D("10")},
        {**keys, "sku": "s1", "date": dt.date(2023, 1, 1), "cuenta": "G2N", "value_lcl": D("-10"),
         "value_usd": None},
        {**keys, "sku": "s2", "date": dt.date(2023, 1, 1), "cuenta": "GROSS_SALES", "value_lcl": D("100"),
         "value_usd": D("10")},
    ]
    df = spark.createDataFrame(rows, ", ".join(
        [f"{k} string" for k in planning.ENRICHED_KEYS if k not in ("date",)] + ["date date"]
        + [f"value_lcl {DEC}", f"value_usd {DEC}"]))
    df = df.select(*planning.ENRICHED_KEYS, "value_lcl", "value_usd")
    out = planning.planning_net_revenue(df).collect()
    assert len(out) == 1
    assert out[0]["sku"] == "s1" and out[0]["value_lcl"] == D("90.00") and out[0]["value_usd"] == D("0")
    from pnlflow.operators.output import planning_final
    final = {r["ACCOUNT_LVL_1"]: r for r in planning_final(df.unionByName(
        planning.planning_net_revenue(df))).where(F.col("SKU") == "s1").collect()}
    assert final["Gross to Net"]["Value_LCL"] == 10.0
    assert final["Net Revenue"]["Value_LCL"] == 90.0


def test_ledger_rules_for_scaled_and_indicator_companies(spark):
    lines = spark.createDataFrame(
        [("2023001", comp, "0001", "0009", str(i), dt.date(2023, 1, 5), cur, ind, None)
         + tuple(D(x) for x in ("1", "10", "-1", "-2", "-3", "-4", "-5", "-6")) + (D("1"),) * 8 + (D("1"),) * 4
         for i, (comp, cur, ind) in enumerate([("CL02", "CLP", "GS"), ("BR02", "BRL", "UD"), ("BR02", "BRL", "GS"),
                                               ("EC02", "USD", "GS"), ("EC02", "ECS", "GS")])],
        "fiscper string, comp_code string, material string, customer string, doc_number string, pstng_date date, "
        "currency string, indicator_a string, indicator_b string, volume decimal(18,2), gross decimal(18,2), "
        "trade_incentive decimal(18,2), consumer_incentive decimal(18,2), other_deduction decimal(18,2), "
        "allowance decimal(18,2), returns decimal(18,2), npd decimal(18,2), "
        + ", ".join(f"cost_man_{i} decimal(18,2)" for i in range(1, 9)) + ", "
        + ", ".join(f"cost_log_{i} decimal(18,2)" for i in range(1, 5)))

    def run(company):
        p = JobParams(company=company)
        return ledger.ledger_base(lines, p).collect()

    cl = run("CL02")[0]
    assert cl["gross_sales"] == D("1000") and cl["sales_allow_returns"] == 100 * D("-4") + D("-5")
    assert cl["currency_copa"] == "CLP" and cl["cogs_manufacturing"] == D("8")
    br = run("BR02")
    assert sorted(r["gross_sales"] for r in br) == [D("0"), D("10")]  # UD drops gross, GS keeps it
    assert sorted(r["sales_allow_returns"] for r in br) == [D("-9"), D("5")]  # UD: gross + returns
    ec = run("EC02")
    assert len(ec) == 1  # a USD company keeps only USD lines
    assert rules.COMPANY_CURRENCY["EC02"] == ec[0]["currency_copa"]
