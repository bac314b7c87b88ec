import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import checks as Q
from quantloom.operators import labels as L
from quantloom.operators import panel as V
from quantloom.operators import portfolio as B
from quantloom.operators import upsert as U
from quantloom.operators import vgraph as G
from quantloom.operators.asof import asof_backward
from quantloom.operators.trees import tree_grid
from quantloom.plans import tables as T
from quantloom.sources import readers as R
from quantloom.sources import writers as W
from quantloom.streaming.candles import append_candles, resample, upsert_stream


def test_asof_join_edges(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 5), (None, 5), ("a", None)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 6, "z"), ("a", None, "w")], "k string, u int, v string")
    got = sorted(((r.k, r.t, r.v) for r in asof_backward(left, right, ["k"], "t", "u", ["v"]).collect()), key=str)
    assert got == sorted([("a", 1, None), ("a", 5, "y"), ("b", 5, None), (None, 5, None), ("a", None, None)], key=str)


def test_upsert(spark):
    a = spark.createDataFrame([(1, "A", 10.0, 2024, 1), (2, "A", 20.0, 2024, 2)], "date int, ticker string, close double, year int, month int")
    b = spark.createDataFrame([(2, "A", 21.0, 2024, 2), (3, "A", 30.0, 2024, 2)], a.schema)
    merged = {(r.date, r.close) for r in U.merge_latest([a, b], ["date", "ticker"]).collect()}
    assert merged == {(1, 10.0), (2, 21.0), (3, 30.0)}
    path = W.new_path(spark, "upsert")
    for batch in (a, b, b):
        U.upsert_partitions(batch, path, ["date", "ticker"], ["year", "month"])
    assert {(r.date, r.close) for r in U.read_table(spark, path).collect()} == merged
    with pytest.raises(ValueError):
        U.upsert_partitions(a.drop("month"), path, ["date", "ticker"], ["year", "month"])


def test_full_refresh_leaves_nothing_behind(spark):
    path = W.new_path(spark, "refresh")
    W.full_refresh(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), path, ["b"])
    W.full_refresh(spark.createDataFrame([(1, 2.0)], "a int, c double"), path)
    assert spark.read.parquet(path).columns == ["a", "c"] and spark.read.parquet(path).count() == 1


def test_padding_is_anchored_on_filing(spark):
    rows = [(1, "shares", date(2019, 12, 31), date(2020, 1, 15), 100.0), (1, "shares", date(2020, 12, 31), date(2020, 1, 20), 200.0), (1, "float", date(2019, 12, 31), date(2020, 1, 18), 5.0), (2, "shares", date(2019, 12, 31), date(2021, 1, 1), 9.0)]
    f = spark.createDataFrame(rows, "cik long, metric string, period_end date, filed date, value double")
    got = {r.reference_date: (r.shares, r.float, r.last_filed) for r in T.padded_facts(f, F.lit("2020-01-22").cast("date")).collect()}
    assert min(got) == date(2020, 1, 15) and max(got) == date(2020, 1, 22) and len(got) == 8
    assert got[date(2020, 1, 17)] == (100.0, None, date(2020, 1, 15)) and got[date(2020, 1, 20)] == (200.0, 5.0, date(2020, 1, 20))


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", float("nan")), (2, None, None)], "k int, s string, v double")
    assert Q.not_null("s")(df).collect()[0].violating_rows == 1 and Q.not_null("k")(df).count() == 0
    assert {r.s for r in Q.in_range("v", high=5)(df).collect()} == {"b"} and Q.finite("v")(df).count() == 1
    assert Q.unique("k")(df).count() == 2 and Q.matches("s", "a")(df).count() == 1 and Q.accepted_values("s", ["a"])(df).count() == 1
    assert Q.not_empty()(df).count() == 0 and Q.not_empty()(df.limit(0)).count() == 1
    assert Q.comparison("k", "<", F.col("v") + 1)(df).count() == 0
    with pytest.raises(ValueError):
        Q.in_range("v")
    with pytest.raises(AssertionError, match="unique: 2 rows; broken"):
        Q.run_checks(df, {"unique": Q.unique("k"), "fine": Q.rejected_values("k", [9]), "broken": lambda x: x.select("absent")})


def test_gaps(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 5)), ("a", date(2024, 1, 9))], "k string, d date")
    assert [r.d for r in Q.no_gaps("d", ["k"], True)(df).collect()] == [date(2024, 1, 8)] and Q.no_gaps("d", ["k"])(df).count() == 3


def test_factor_csv(spark):
    path = W.new_path(spark, "europe")
    lines = ["made by a tool", ",Mkt-RF,SMB,HML,RMW,CMA,RF", "20240102,  0.10, -0.2, 0.3, 0.1, 0.0, 0.01", "", "Copyright"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    row = R.read_factor_csv(spark, path, r"/(europe)[^/]*/[^/]*$").collect()
    assert len(row) == 1 and (row[0].region, row[0].timeframe, row[0].smb) == ("europe", date(2024, 1, 2), -0.2)


def test_documents_that_cannot_be_read(spark):
    docs = spark.createDataFrame([("{broken", "CIK0000000042.json"), ('{"cik": 7, "facts": {}}', "CIK0000000007.json")], "value string, file string")
    companies = R.parse_facts(docs)
    assert {r.cik for r in companies.collect()} == {42, 7} and R.fact_rows(companies, "dei", "x", "USD").count() == 0 and R.indicator_catalogue(companies).count() == 0


def test_embedding_of_a_rank_one_panel_and_its_alignment(spark):
    rng = np.random.default_rng(1)
    base, turn = rng.normal(size=(12, 3)), np.linalg.qr(rng.normal(size=(3, 3)))[0]
    a, b = date(2020, 1, 1), date(2020, 7, 1)
    rows = [(a, i, (base[i] @ turn).tolist()) for i in range(12)] + [(b, i, base[i].tolist()) for i in range(12)]
    out = V.align_windows(spark.createDataFrame(rows, "window_end date, symbol long, embedding array<double>"))
    for r in out.collect():
        assert np.allclose(r.aligned, base[r.symbol])
    report = V.alignment_report(out, a, b).first()
    assert report.cosine_after == pytest.approx(1.0) and report.gap == pytest.approx(0.0, abs=1e-9)
    z = np.outer(rng.normal(size=5), rng.normal(size=8))
    panel = spark.createDataFrame([(a, i, a + timedelta(days=j), float(z[i, j])) for i in range(5) for j in range(8)], "window_end date, symbol long, day date, z double")
    e = np.array([r.embedding for r in V.embeddings(panel, "day", 2).orderBy("symbol").collect()])
    assert np.allclose(e @ e.T, z @ z.T)


def test_loadings_of_exact_data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 3))
    rows = [(date(2020, 1, 1), 1, *map(float, v), float(0.5 + v @ [1.0, -2.0, 3.0])) for v in x] + [(date(2020, 1, 1), 2, 1.0, 1.0, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "window_end date, symbol long, mkt_rf double, smb double, hml double, excess double")
    got = {r.symbol: r for r in V.factor_loadings(df).collect()}
    assert [got[1].alpha, got[1].beta_mkt_rf, got[1].beta_smb, got[1].beta_hml] == pytest.approx([0.5, 1.0, -2.0, 3.0])
    assert [got[2].alpha, got[2].beta_smb] == pytest.approx([1.0, 1.0])  # the least solution


def test_single_period_curves(spark):
    d0, d1 = date(2024, 1, 1), date(2024, 1, 2)
    for p1, expected in ((50.0, 1000.0), (60.0, 1200.0), (40.0, 800.0)):
        c = spark.createDataFrame([("X", d0, 50.0, 50.0), ("X", d1, p1, p1)], "symbol string, timeframe date, high double, low double")
        r = spark.createDataFrame([(d0,)], "rebalance date")
        chosen = spark.createDataFrame([("X", d0)], "symbol string, rebalance date")
        assert {x.timeframe: x.value for x in B.equity_curve(B.allocate(chosen, c), r, c).collect()}[d1] == pytest.approx(expected)
        nothing = B.equity_curve(B.allocate(chosen.limit(0), c), r, c)
        assert {x.value for x in nothing.collect()} == {1000.0}


def test_performance_of_flat_and_falling_curves(spark):
    rows = [("flat", date(2024, 1, i), 100.0) for i in range(1, 4)] + [("fall", date(2024, 1, i), v) for i, v in ((1, 100.0), (2, 50.0), (3, 75.0))] + [("one", date(2024, 1, 1), 5.0)]
    got = {r.k: r for r in B.performance(spark.createDataFrame(rows, "k string, timeframe date, value double"), ["k"]).collect()}
    assert got["flat"].sharpe is None and got["one"].volatility is None and got["fall"].max_drawdown == -0.5 and got["fall"].days_under_water == 2


def test_visibility_graph_against_its_definition(spark):
    y = np.random.default_rng(3).normal(size=15)
    d = date(2024, 1, 1)
    rows = spark.createDataFrame([(d, 1, d + timedelta(days=i), float(v)) for i, v in enumerate(y)], "window_end date, symbol long, timeframe date, open double")
    p = G.graph_points(rows)
    edges = {(r.i, r.j) for r in G.visibility_edges(p).collect()}
    expected = {(i, j) for i in range(15) for j in range(i + 1, 15) if all(y[k] < y[i] + (y[j] - y[i]) * (k - i) / (j - i) for k in range(i + 1, j))}
    assert edges == expected
    line = spark.createDataFrame([(d, 1, 0, 1), (d, 1, 1, 2)], "window_end date, symbol long, i int, j int")
    m = G.path_measures(line).first()
    assert m.mean_path == pytest.approx(8 / 6) and m.mean_betweenness == pytest.approx(1 / 3)
    assert G.clustering(line).first().clustering == 0.0 and math.isclose(G.power_law(line).first().exponent, 1.0)


def test_stream_gives_the_same_candles_as_the_table(spark):
    t = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 17 as int)) as ts, id % 3 as symbol, id as event_id, cast(id % 11 as double) as value from range(200)").withColumn("ts", F.col("ts").cast("timestamp"))
    path = W.new_path(spark, "ticks")
    t.write.parquet(path)
    stream = resample(spark.readStream.schema(t.schema).parquet(path), "1 hour", "10 minutes")
    q = stream.writeStream.format("memory").queryName("ticks_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("ticks_out").collect())) == sorted(map(tuple, resample(t, "1 hour").collect()))


def test_late_ticks_change_nothing_that_is_written(spark):
    source, target, marks = (W.new_path(spark, n) for n in ("ticks", "candles", "marks"))
    tick = lambda *rows: spark.createDataFrame([(f"2024-01-01 {t}", 1, i, v) for i, (t, v) in enumerate(rows)], "ts string, symbol int, event_id int, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    found = []
    for batch in (tick(("00:10:00", 1.0), ("00:50:00", 2.0)), tick(("05:00:00", 3.0)), tick(("00:20:00", 9.0), ("04:58:00", 4.0)), tick(("09:00:00", 0.0))):
        batch.write.mode("append").parquet(source)
        found.append(append_candles(spark.readStream.schema(batch.schema).parquet(source), target, marks, "1 hour", "30 minutes"))
    got = sorted((r.timeframe.hour, r.open, r.close, r.volume) for r in spark.read.parquet(target).collect())
    assert got == [(0, 1.0, 2.0, 2), (4, 4.0, 4.0, 1), (5, 3.0, 3.0, 1)] and found == [0, 0, 1, 0]


def test_stream_upserts_corrections(spark):
    source, target, marks = (W.new_path(spark, n) for n in ("in", "out", "marks"))
    first = spark.createDataFrame([(1, "a", 2024), (2, "b", 2024)], "k int, v string, year int")
    first.write.parquet(source)
    for batch in (None, spark.createDataFrame([(2, "c", 2024)], first.schema)):
        if batch is not None:
            batch.write.mode("append").parquet(source)
        upsert_stream(spark.readStream.schema(first.schema).parquet(source), target, ["k"], ["year"], marks).awaitTermination()
    assert {(r.k, r.v) for r in U.read_table(spark, target).collect()} == {(1, "a"), (2, "c")}


def wavy_candles(spark, n=620, gaps=False):
    rows = []
    for s in range(4):
        for t in range(n):
            if not gaps or (t * 7 + s * 3) % 5:
                price = 100 + 20 * math.sin(t / (15 + 9 * s) + s) + 0.03 * s * t
                rows.append((s, date(2020, 1, 1) + timedelta(days=t), price, price + 1, price - 1))
    return spark.createDataFrame(rows, "symbol int, timeframe date, close double, high double, low double")


def test_momentum_meets_both_ends_of_each_window(spark):
    candles = wavy_candles(spark, 300, gaps=True)
    days = B.rebalance_days(candles, "monthly", 2, 1)
    prices = {(r.symbol, r.timeframe): r.close for r in candles.collect()}
    expected = {}
    for (day,) in days.collect():
        from_day = spark.sql(f"select add_months(date'{day}', -2)").first()[0]
        for s in range(4):
            inside = sorted(t for k, t in prices if k == s and from_day <= t <= day - timedelta(days=21))
            if inside:
                expected[day, s] = prices[s, inside[-1]] / prices[s, inside[0]] - 1
    got = B.momentum_choice(candles, days, 2, 3, 10).collect()
    assert {(r.rebalance, r.symbol) for r in got} == set(expected)
    assert all(r.momentum == pytest.approx(expected[r.rebalance, r.symbol]) for r in got)
    assert B.momentum_choice(candles.limit(0), days).count() == 0


def test_adaptive_choice_is_the_best_single_curve(spark):
    candles = wavy_candles(spark).cache()
    day = date(2021, 7, 1)
    optimise = spark.createDataFrame([(day,)], "rebalance date")
    tried = {}
    for months in (2, 3):
        for frequency in ("monthly", "quarterly"):
            firsts = B.rebalance_days(candles, frequency, 0, 0).where(F.col("rebalance").between(F.lit(date(2020, 7, 1)), F.lit(day - timedelta(days=1))))
            curve = B.equity_curve(B.allocate(B.momentum_choice(candles, firsts, months, 1, 2), candles), firsts, candles)
            tried[months, frequency] = B.performance(curve.where(F.col("timeframe") < F.lit(day))).first().sharpe
    best = max(tried, key=tried.get)
    got = B.adaptive_choice(candles, optimise, [2, 3], [1], [2], ["monthly", "quarterly"]).collect()
    assert [(r.rebalance, r.months, r.weeks, r.top, r.frequency) for r in got] == [(day, best[0], 1, 2, best[1])]
    assert got[0].sharpe == pytest.approx(tried[best])
    early = B.adaptive_choice(candles, spark.createDataFrame([(date(2019, 1, 1),)], "rebalance date"), [2, 3], [1], [2]).first()
    assert (early.months, early.weeks, early.top, early.frequency, early.sharpe) == (2, 1, 2, "monthly", None)


def test_lasso_of_orthogonal_features_shrinks_each_by_alpha(spark):
    rows = [(float(a), float(b), 3.0 * a + 0.2 * b) for a in (-1, 1) for b in (-1, 1)] * 200
    got = L.lasso_weights(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y", 1.0).collect()
    assert [r.feature for r in got] == ["a", "b"]
    assert got[0].weight == pytest.approx(2, abs=0.02) and got[1].weight == pytest.approx(0, abs=1e-6)


def test_tree_grid_tells_deep_from_shallow(spark):
    rows = spark.createDataFrame([(float(a), float(b), "yes" if a != b else "no") for a in (0, 1) for b in (0, 1) for _ in range(10 + 5 * a)], "a double, b double, y string")
    got = tree_grid(rows, rows, ["a", "b"], "y", {"maxDepth": [0, 2]}).collect()
    assert [r.parameters for r in got] == ["{'maxDepth': 0}", "{'maxDepth': 2}"]
    assert got[0].accuracy == pytest.approx(0.5) and got[1].accuracy == 1 and got[1].macro_f1 == 1


def test_adjacent_cosine_needs_the_period_just_before(spark):
    rows = [("a", 1, [1.0, 0.0]), ("a", 2, [0.0, 2.0]), ("a", 3, [0.0, 1.0]), ("b", 1, [1.0, 1.0]), ("b", 3, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "symbol string, window_end int, embedding array<double>")
    got = {(r.symbol, r.window_end, r.before): r.cosine for r in V.adjacent_cosine(vectors).collect()}
    assert got == {("a", 2, 1): pytest.approx(0), ("a", 3, 2): pytest.approx(1)}


def test_joint_graph_table_of_a_triangle_and_a_path(spark):
    day = date(2020, 1, 31)
    rows = [(day, s, day - timedelta(days=9 - i), y) for s, values in ((1, [3.0, 1.0, 3.0]), (2, [1.0, 3.0, 1.0])) for i, y in enumerate(values)]
    points = G.graph_points(spark.createDataFrame(rows, "window_end date, symbol long, timeframe date, open double"))
    got = {r.symbol: r for r in G.visibility_measures(points, G.visibility_edges(points)).collect()}
    triangle, path = got[1], got[2]
    assert (triangle.density, triangle.mean_degree, triangle.clustering, triangle.mean_path, triangle.mean_betweenness) == pytest.approx((1, 2, 1, 1, 0))
    assert triangle.assortativity is None and triangle.exponent is None  # all degrees are equal
    assert (path.density, path.mean_degree, path.clustering, path.mean_path, path.mean_betweenness) == pytest.approx((2 / 3, 4 / 3, 0, 4 / 3, 1 / 3))
    assert path.assortativity == pytest.approx(-1) and path.exponent == pytest.approx(1)  # degree 1 twice, degree 2 once
