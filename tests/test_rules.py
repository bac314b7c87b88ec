"""Batched path search, files grouped by schema, and rules and metrics that a caller brings."""

from collections import deque
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import labels as L
from quantloom.operators import portfolio as B
from quantloom.operators import vgraph as G
from quantloom.sources import readers as R
from quantloom.sources import writers as W

DAY = date(2024, 1, 1)


def searched(edges):
    """Mean distance and mean betweenness by a search from every node that counts shortest paths through each other node."""
    near = {}
    for i, j in edges:
        near.setdefault(i, set()).add(j)
        near.setdefault(j, set()).add(i)
    far, ways = {}, {}
    for s in near:
        far[s, s], ways[s, s], queue = 0, 1, deque([s])
        while queue:
            u = queue.popleft()
            for v in near[u]:
                if (s, v) not in far:
                    far[s, v], ways[s, v] = far[s, u] + 1, 0
                    queue.append(v)
                if far[s, v] == far[s, u] + 1:
                    ways[s, v] += ways[s, u]
    n = len(near)
    through = [sum(ways[s, v] * ways[v, t] / ways[s, t] for s in near for t in near if len({s, t, v}) == 3 and far[s, v] + far[v, t] == far[s, t]) for v in near]
    return sum(far.values()) / (n * (n - 1)), sum(through) / n / ((n - 1) * (n - 2)) if n > 2 else 0.0


def test_paths_of_many_graphs_against_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(G, "CELLS", 500)
    rng, graphs = np.random.default_rng(8), {}
    for k, n in enumerate([2, 3, 5, 5, 5, 9, 9, 30, 64, 65, 70]):
        tree = {(int(rng.integers(max(0, j - 3), j)), j) for j in range(1, n)}
        extra = {tuple(sorted(rng.choice(n, 2, replace=False).tolist())) for _ in range(n // 2)}
        graphs[k] = {(3 * a, 3 * b) for a, b in tree | extra}  # nodes need not be numbered without gaps
    rows = spark.createDataFrame([(DAY, k, i, j) for k, edges in graphs.items() for i, j in edges], "window_end date, symbol long, i long, j long")
    got = {r.symbol: (r.mean_path, r.mean_betweenness) for r in G.path_measures(rows).collect()}
    assert got == {k: pytest.approx(searched(edges)) for k, edges in graphs.items()}
    assert G.path_measures(rows.where("symbol < 0")).count() == 0
    with pytest.raises(Exception, match="not connected"):
        G.path_measures(spark.createDataFrame([(DAY, 1, 0, 1), (DAY, 1, 2, 3)], rows.schema)).collect()


def test_a_folder_of_mixed_files_reads_without_naming_groups(spark):
    path = W.new_path(spark, "mixed folder")
    write = lambda sql, to=path: spark.sql(sql).coalesce(1).write.mode("append").parquet(to)
    write("select timestamp_ntz'2020-01-01 00:00:00' as date, 'a' as ticker, 1.5d as close, 7 as extra")
    write("select '2020-01-02 00:00:00' as date, 'b' as ticker, cast(2 as decimal(9,2)) as close")
    write("select date'2020-01-03' as date, 'c' as ticker, 3 as close, map(1, 2) as extra", f"{path}/year=2020")
    write("select 'd' as ticker, date'2020-01-04' as date")  # no close, another order
    groups = R.physical_schemas(spark, path, ["date", "ticker", "close"]).collect()
    assert sorted(len(g.files) for g in groups) == [1, 1, 1, 1]
    got = R.read_drifting(spark, path, ["date", "ticker", "close"], {"close": "double"})
    assert [(str(r.date.date()), r.ticker, r.close) for r in got.orderBy("ticker").collect()] == [("2020-01-01", "a", 1.5), ("2020-01-02", "b", 2.0), ("2020-01-03", "c", 3.0), ("2020-01-04", "d", None)]
    assert dict(got.dtypes)["date"] == "timestamp_ntz"
    same = W.new_path(spark, "same")
    for n in range(3):
        write(f"select {n} as close, {n} as other_{n}", same)
    assert [len(g.files) for g in R.physical_schemas(spark, same, ["close"]).collect()] == [3]  # columns that nobody asks for split nothing


def candles(spark):
    rows = [(s, DAY + timedelta(days=i), p, p, v) for i in range(70) for s, p, v in (("a", 10.0 + i, 30.0), ("b", 10.0, 10.0), ("c", 5.0, 0.0))]
    return spark.createDataFrame(rows, "symbol string, timeframe date, high double, low double, volume double")


def test_backtest_of_a_callers_rule(spark):
    c = candles(spark)
    half = lambda _, days: days.crossJoin(spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", float("nan")), ("gone", 9.0), ("b", None)], "symbol string, weight double"))
    bought = B.price_weights(half(c, B.rebalance_days(c, months=1)), c).collect()
    assert {(r.symbol, r.weight) for r in bought} == {("a", 0.75), ("b", 0.25)}
    curve = {r.timeframe: r.value for r in B.backtest(c, half, months=1).collect()}
    start, nxt = date(2024, 2, 8), date(2024, 3, 1)
    base = {d: 10.0 + (d - DAY).days for d in (start, nxt)}
    assert curve[start] == pytest.approx(1000) and curve[nxt] == pytest.approx(1000 * (0.75 * base[nxt] / base[start] + 0.25))
    nothing = B.backtest(c, lambda _, days: days.selectExpr("rebalance", "'x' symbol", "1d weight"), months=1)
    assert {r.value for r in nothing.collect()} == {1000.0}


def test_turnover_rule_looks_back_only(spark):
    c = candles(spark).withColumn("volume", F.expr("case when symbol = 'b' and timeframe >= '2024-03-01' then 1e9 else volume end"))
    days = spark.createDataFrame([(date(2024, 3, 1),)], "rebalance date")
    got = {r.symbol: r.weight for r in B.turnover_rule(10, 5)(c, days).collect()}
    assert got == {"a": 300.0, "b": 100.0}
    assert [r.symbol for r in B.turnover_rule(10, 1)(c, days).collect()] == ["a"]


def test_callers_metrics(spark):
    rows = spark.createDataFrame([("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), ("z", "x"), (None, "x"), ("x", None)], "label string, prediction string")
    whole = {"n": F.count(F.lit(1)), "right": F.sum((F.col("label") == F.col("prediction")).cast("int"))}
    got = {(r.metric, r["class"]): r.value for r in L.metric_report(rows, whole, {c: F.col(c) for c in ("tp", "fp", "fn", "tn")} | {"precision": F.expr("try_divide(tp, tp + fp)")}).collect()}
    assert got["n", None] == 7 and got["right", None] == 3
    assert [got[m, "x"] for m in ("tp", "fp", "fn", "tn")] == [1, 2, 2, 2] and [got[m, "z"] for m in ("tp", "fp", "fn", "tn")] == [0, 0, 1, 6]
    assert got["precision", "z"] is None and got["precision", "y"] == pytest.approx(2 / 3)
    empty = L.metric_report(rows.limit(0), {"n": F.count(F.lit(1))}, {"tp": F.col("tp")}).collect()
    assert [(r.metric, r.value) for r in empty] == [("n", 0.0)]
    with pytest.raises(ValueError):
        L.metric_report(rows, {})
