import math
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.functions import expr as E
from quantloom.operators import labels as L
from quantloom.plans import tables as T


def values(df, c="x"):
    return [r[c] for r in df.orderBy("t").select(c).collect()]


def test_returns_and_sharpe(spark):
    df = spark.createDataFrame([(1, 10.0, 10.0), (2, 0.0, 10.0), (3, -5.0, 10.0), (4, 10.0, 0.0), (5, 105.0, 100.0)], "t int, a double, b double")
    assert values(df.select("t", E.log_return(F.col("a"), F.col("b")).alias("x")))[:4] == [0.0, None, None, None]
    assert values(df.select("t", E.arithmetic_return(F.col("a"), F.col("b")).alias("x")))[3:] == [None, pytest.approx(0.05)]
    s = spark.createDataFrame([(1, 0.1, 0.2), (2, 0.1, 0.0), (3, 0.1, None)], "t int, r double, v double")
    assert values(s.select("t", E.sharpe_ratio(F.col("r"), F.col("v")).alias("x"))) == [0.5, None, None]


def test_ieee_division(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, -1.0, 0.0), (3, 0.0, 0.0), (4, None, 0.0), (5, 3.0, 2.0), (6, 1.0, None)], "t int, a double, b double")
    got = values(df.select("t", E.ieee_div(F.col("a"), F.col("b")).alias("x")))
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3:] == [None, 1.5, None]


def test_relative_strength(spark):
    w = Window.partitionBy("s").orderBy("t")
    rows = [("up", i, 100.0 + i) for i in range(20)] + [("down", i, 200.0 - i) for i in range(20)]
    df = spark.createDataFrame(rows, "s string, t int, close double")
    df = df.withColumn("x", E.relative_strength(F.col("close") - F.lag("close").over(w), w, 14))
    up, down = values(df.where("s = 'up'")), values(df.where("s = 'down'"))
    assert math.isnan(up[0]) and set(up[1:]) == {100.0} and set(down[1:]) == {0.0}


def test_volatility_of_one_value_is_null(spark):
    w = Window.orderBy("t")
    df = spark.createDataFrame([(1, 0.1), (2, 0.3), (3, None)], "t int, r double")
    assert values(df.select("t", E.volatility(F.col("r"), w, 2).alias("x"))) == [None, pytest.approx(0.1414213562), None]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 0.5), (4, None)], "t int, v double")
    assert values(df.select("t", E.cut(F.col("v"), [0.0]).alias("x"))) == ["(-inf, 0]", "(-inf, 0]", "(0, inf]", None]
    with pytest.raises(ValueError):
        E.cut(F.col("v"), [0.0], ["one"])


def test_dates(spark):
    df = spark.createDataFrame([(1, date(2021, 1, 1), "2021-02-30"), (2, date(2024, 3, 31), "2024-02-29")], "t int, d date, s string")
    week = df.select("t", E.period_key(F.col("d"), "weekly").alias("x"))
    assert [tuple(v) for v in values(week)] == [(2020, 53), (2024, 13)]
    assert values(df.select("t", E.lenient_date(F.col("s")).alias("x"))) == [None, date(2024, 2, 29)]
    assert values(df.select("t", F.size(E.days_between(F.col("d"), F.date_sub("d", 1))).alias("x"))) == [0, 0]


def test_future_returns(spark):
    rows = [("A", i, v) for i, v in enumerate([100.0, 102.0, 101.0, 103.0, 104.0, 106.0])] + [("B", i, v) for i, v in enumerate([50.0, 55.0, 45.0])]
    df = spark.createDataFrame(rows, "symbol string, timeframe int, open double").orderBy(F.rand(1))
    out = T.append_future_returns
    got = {(r.symbol, r.timeframe): (r.future_price, r.future_class) for r in out(df, 2, [0.0, 0.05]).collect()}
    assert got[("A", 0)] == (101.0, "(0, 0.05]") and got[("B", 0)] == (45.0, "(-inf, -0.05]")
    assert got[("A", 4)] == got[("A", 5)] == got[("B", 1)] == (None, None)
    with pytest.raises(ValueError):
        out(df, 1, [0.1], ["a", "b"])


def test_causal_zscore_and_metrics(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 3.0), ("A", 3, None), ("B", 1, 5.0)], "symbol string, timeframe int, v double")
    got = {(r.symbol, r.timeframe): r.v_z for r in L.causal_zscore(df, ["v"]).collect()}
    assert got[("A", 1)] == 0.0 and got[("A", 2)] == pytest.approx(0.70710678) and got[("A", 3)] == 0.0 and got[("B", 1)] == 0.0
    p = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, prediction string")
    m = {r["class"]: r for r in L.classification_metrics(p).collect()}
    assert m["c"].precision == 0.0 and m["c"].recall == 0.0 and m["a"].recall == 0.5 and m["b"].precision == pytest.approx(1 / 3) and m["a"].accuracy == 0.5


def test_spearman_with_ties(spark):
    x, y = [1, 2, 2, 3, 10, 7], [5, 4, 4, 1, 0, 2]
    rows = spark.createDataFrame([("f", float(a), float(b)) for a, b in zip(x, y)] + [("flat", 1.0, 2.0), ("flat", 1.0, 3.0)], "feature string, x double, y double")
    import pandas as pd

    got = {r.feature: r.rho for r in L.spearman(rows).collect()}
    assert got["f"] == pytest.approx(pd.Series(x).rank().corr(pd.Series(y).rank())) and got["flat"] is None
