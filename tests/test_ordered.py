"""Hot keys: cut into blocks they give what one window gives, and no task holds much of them."""

import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators import ordered as O
from quantloom.operators import panel as V
from quantloom.operators.asof import asof_backward, range_join
from quantloom.plans import tables as T

SCHEMA = "symbol int, timeframe date, open double, close double, high double, low double, volume double"


def prices(spark, sizes, odd=()):
    """Waves with gaps, and ``odd`` prices {(symbol, day): (open, close)}."""
    rng = np.random.default_rng(4)
    rows = []
    for s, n in enumerate(sizes):
        close = 50 + 20 * np.sin(np.arange(n) / 9 + s) + rng.normal(size=n)
        for t in range(n):
            o, c = dict(odd).get((s, t), (float(close[t]) - 0.5, float(close[t])))
            rows.append((s, date(2000, 1, 1) + timedelta(days=t), o, c, 100.0, 1.0, float(t % 7)))
    return spark.createDataFrame(rows, SCHEMA)


def seen(df, keys=("symbol", "timeframe")):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-12, nan_ok=True)
    return a == b


def test_indicators_of_hot_symbols_are_those_of_one_window(spark, monkeypatch):
    monkeypatch.setattr(O, "BLOCK_ROWS", 1)
    candles = prices(spark, [2500, 40, 1], odd={(0, 700): (None, None), (0, 1300): (float("nan"), 1e14)}.items())
    whole, cut = seen(T.candles_daily(candles, None)), seen(T.candles_daily(candles, 100))
    assert set(whole) == set(cut) and len(whole) == 2541
    for k, r in whole.items():
        assert all(same(a, b) for a, b in zip(r, cut[k])), k
    assert T.candles_daily(candles.limit(0)).count() == 0


def test_indicators_against_plain_windows(spark):
    candles = prices(spark, [300], odd={(0, 50): (None, None), (0, 120): (7.0, -1.0)}.items())
    w = Window.partitionBy("symbol").orderBy("timeframe")
    diff, ret = F.col("close") - F.col("before"), F.when((F.col("close") > 0) & (F.col("before") > 0), F.ln(F.col("close") / F.col("before")))
    plain = candles.withColumn("before", F.lag("close").over(w)).withColumn("ret", ret).withColumn("gain", F.when(diff > 0, diff).otherwise(0.0)).withColumn("loss", F.when(diff < 0, -diff).otherwise(0.0))
    last = lambda n: w.rowsBetween(1 - n, 0)
    got = seen(T.candles_daily(candles))
    for r in plain.select("*", F.avg("open").over(last(20)).alias("o"), F.stddev_samp("ret").over(last(62)).alias("v"), F.avg("gain").over(last(14)).alias("g"), F.avg("loss").over(last(14)).alias("l")).collect():
        mine = got[r.symbol, r.timeframe]
        assert same(mine.open_rolling_1m, r.o) and same(mine.volatility_1q, r.v) and same(mine.log_return_1d, r.ret)
        rsi = 100 - 100 / (1 + r.g / r.l) if r.l else (100.0 if r.g else math.nan)
        assert mine.rsi == pytest.approx(rsi, nan_ok=True)


def test_odd_prices_matter_in_their_own_windows_only(spark):
    day = lambda i: date(2000, 1, 1) + timedelta(days=i)
    flat = [(0, day(i), 10.0, 10.0 * 2.0**i, 1.0, 1.0, 1.0) for i in range(12)]  # the same return each day
    odd = [(1, day(i), v, v, 1.0, 1.0, 1.0) for i, v in enumerate([5.0, 1e14, 6.0, float("nan"), 7.0, float("inf"), 8.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0])]
    got = seen(T.candles_daily(spark.createDataFrame(flat + odd, SCHEMA)))
    assert got[0, day(9)].volatility_1w == 0 and got[0, day(9)].sharpe_1w is None and got[0, day(9)].rsi == 100
    assert got[1, day(1)].open_rolling_1w == (5 + 1e14) / 2 and math.isnan(got[1, day(4)].open_rolling_1w) and math.isnan(got[1, day(5)].open_rolling_1w)
    assert got[1, day(9)].open_rolling_1w == math.inf and got[1, day(10)].open_rolling_1w == 8.8 and got[1, day(12)].open_rolling_1w == 9
    assert got[1, day(12)].volatility_1w == 0 and got[1, day(3)].log_return_1d is not None and math.isnan(got[1, day(3)].log_return_1d)


def test_running_states_of_hot_keys(spark):
    rows = [("hot", i, float(math.sin(i) * i) if i % 5 else None, "x" if i == 0 else None) for i in range(3000)] + [("a", i, 1.0 * i, None) for i in range(20)] + [(None, i, -1.0, "n") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, v double, s string")
    states = {"total": ("sum", F.col("v")), "n": ("count", F.col("v")), "high": ("max", F.col("v")), "low": ("min", F.col("v")), "seen": ("last", F.col("s")), "latest": ("last", F.col("v"))}
    whole, cut = (seen(O.running_states(df, ["k"], ["t"], states, h, 64), ("k", "t")) for h in (None, 100))
    assert set(whole) == set(cut) and len(whole) == 3420
    assert all(same(a, b) for k, r in whole.items() for a, b in zip(r, cut[k]))
    assert whole["hot", 2999].seen == "x" and whole["a", 3].seen is None and O.running_states(df.limit(0), ["k"], ["t"], states, 10).count() == 0


def test_asof_join_of_a_hot_key(spark):
    left = spark.createDataFrame([("hot", i) for i in range(2000)] + [("b", 5), (None, 3)], "k string, t int")
    right = spark.createDataFrame([("hot", 7, "x", 1), ("hot", 1500, None, 2), ("b", 1, "z", 3)], "k string, u int, v string, w int")
    for each in (False, True):
        whole, cut = (sorted(map(str, asof_backward(left, right, ["k"], "t", "u", ["v", "w"], each, h).collect())) for h in (None, 50))
        assert whole == cut and len(cut) == 2002


def test_no_task_holds_a_quarter_of_a_million_rows_of_one_symbol(spark):
    df = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") % 11).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these tasks are so small that they would be merged
    try:
        ran = []

        def build(part, keys, order):
            w = Window.partitionBy(*keys).orderBy(*order)
            out = part.withColumn("m", F.sum("v").over(w.rowsBetween(-99, 0))).withColumn("task", F.spark_partition_id())
            ran.append(keys)
            return out

        out = O.trailing_windows(df, ["k"], ["t"], 99, build, 100_000)
        sizes = [r.n for r in out.groupBy("task").agg(F.count("m").alias("n")).collect()]  # the window must run
        assert ran[-1] == ["k", "__block"] and sum(sizes) == 1_000_000 and max(sizes) < 250_000
        wrong = out.where("m <> if(t < 99, -1, 0)").where("t >= 99").withColumn("real", F.expr("aggregate(sequence(t - 99, t), 0L, (a, x) -> a + x % 11)")).where("m <> real")
        assert wrong.count() == 0
        states = O.running_states(df, ["k"], ["t"], {"total": ("sum", F.col("v")), "high": ("max", F.col("t"))}, 100_000).withColumn("task", F.spark_partition_id())
        assert max(r.n for r in states.groupBy("task").agg(F.count("total").alias("n"), F.max("high")).collect()) < 250_000
        assert states.where("total <> (t div 11) * 55 + ((t % 11) * (t % 11 + 1)) div 2 OR high <> t").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rolling_loadings_are_those_of_whole_windows(spark):
    rng = np.random.default_rng(8)
    months = [date(2018 + i // 12, i % 12 + 1, 1) for i in range(30)]
    factors = spark.createDataFrame([(m, *map(float, rng.normal(size=3)), 0.0) for m in months if m != months[20]], "timeframe date, mkt_rf double, smb double, hml double, rf double")
    rows = []
    for s in range(12):
        for i, m in enumerate(months):
            if s == 1 and 9 <= i < 12 or s == 2 and i % 4 == 0 or s == 3 and i > 15:
                continue  # a gap over a block's end, too many gaps, an early end
            rows.append((s, m, None if (s + i) % 17 == 0 else float("inf") if (s + i) % 29 == 0 else float(rng.normal())))
            if s == 4:
                rows.append((s, m, -100.0))
    df = spark.createDataFrame(rows, "symbol int, timeframe date, excess double")
    first, last = months[0], date(2020, 6, 30)
    ends = V.all_window_ends(df.union(spark.createDataFrame([(99, last, None)], df.schema)), "timeframe", 3, 12)
    whole = V.complete_panel(V.assign_windows(df, "timeframe", ends, 12), "timeframe", "excess", 0.3)
    expected = seen(V.factor_loadings(whole.join(factors, "timeframe")), ("window_end", "symbol"))
    got = seen(V.rolling_loadings(df, factors, "timeframe", first, last, 12, 3, 0.3), ("window_end", "symbol"))
    assert set(got) == set(expected) and len({k[0] for k in got}) == 7 and any(k[1] == 1 for k in got)
    assert all(same(a, b) for k, r in expected.items() for a, b in zip(r[2:], got[k][2:]))
    with pytest.raises(ValueError):
        V.rolling_loadings(df, factors, "timeframe", first, last, 36, 5)
    assert V.rolling_loadings(df.limit(0), factors, "timeframe", None, None).count() == 0


def test_range_join_against_all_pairs_without_a_loop(spark):
    day = lambda i: date(2020, 1, 1) + timedelta(days=i)
    left, right = [(k, day(k * 13 % 90)) for k in range(25)] + [(99, None), (100, day(500))], [day(i * 7) for i in range(14)] + [day(13), None]
    a, b = spark.createDataFrame(left, "k int, first date"), spark.createDataFrame([(x,) for x in right], "d date")
    for width in (1, 10, 400):
        got = sorted((r.k, r.d) for r in range_join(a, b, "first", "d", width).collect())
        assert got == sorted((k, x) for k, f in left for x in right if f and x and x >= f)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = range_join(a, b, "first", "d")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert range_join(a, b.limit(0), "first", "d").count() == 0 and range_join(a.limit(0), b, "first", "d").count() == 0
