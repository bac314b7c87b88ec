"""Candles and features in blocks: the same numbers as in tables, and little on disk."""

import os
import time
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import blocks as K
from quantloom.operators import features as X
from quantloom.operators import labels as L
from quantloom.operators import trees
from quantloom.plans import more_queries, registry  # noqa: F401
from quantloom.plans import tables as T
from quantloom.sources import panels as P
from quantloom.sources import writers as W

DATA = "/root/testdata/sf0.001"


def odd_candles(spark):
    rng, odd = np.random.default_rng(8), [None, float("nan"), float("inf"), 0.0, -0.0, -3.0]
    price = lambda s: odd[rng.integers(len(odd))] if s == 3 and rng.random() < 0.1 else 7.0 if s == 2 else float(rng.integers(1, 900)) / 7
    rows = [(s if s else None, date(2020, 1, 1) + timedelta(days=3 * i), *[price(s) for _ in range(5)]) for s, n in enumerate((40, 300, 270, 290, 1, 2)) for i in range(n)]
    rows += [(1, date(2019, 1, 1), 1.0, 2.0, 3.0, 1.0, None)]
    return spark.createDataFrame(rows, "symbol long, timeframe date, open double, close double, high double, low double, volume double")


@pytest.mark.parametrize("rows", [1, 1 << 16])
def test_columns_of_blocks_are_those_of_tables(spark, rows):
    candles = odd_candles(spark)
    table = T.append_future_returns(T.candles_daily(candles, None), 5)
    names = [*T.PRICES, "future_price", *T.INDICATORS]
    assert sorted(T.INDICATORS) == sorted(c for c, t in table.dtypes if t == "double" and c not in (*T.PRICES, "future_price"))
    table = L.causal_zscore(table, list(T.INDICATORS)).orderBy("symbol", "timeframe").toPandas()
    blocks = T.candle_blocks(candles.repartition(3, "symbol"), rows).collect()
    assert len(blocks) == 6 if rows == 1 else len(blocks) <= 3
    plain, scored = ({c: [] for c in names} for _ in range(2))
    order = []
    for b in sorted(blocks, key=lambda b: b.block):
        starts, day, _ = T.candle_columns(b.asDict(), ["open"])
        order += [(int(d), len(starts)) for d in day]
        for found, of in ((plain, T.plain_values), (scored, T.scored_values)):
            for c, x in of(b.asDict(), names).items():
                found[c] += x.tolist()
    assert len(order) == len(table)
    by_value = lambda frame, columns: sorted((tuple(repr(round(float(v), 9) + 0.0) for v in r) for r in zip(*[frame[c] for c in columns])))
    assert by_value(plain, [*T.PRICES, "future_price", *T.INDICATORS]) == by_value(table, names)
    assert by_value(scored, names) == by_value(table, [*T.PRICES, "future_price", *[f"{c}_z" for c in T.INDICATORS]])


def test_packed_entries(spark):
    for x in (np.array([], float), np.array([1.0, -0.0, np.nan, np.inf]), np.arange(-5, 5000)):
        assert np.array_equal(K.unpack(K.pack(x), len(x), x.dtype.type).view(np.int64), x.view(np.int64))
    blocks, read = K.packed(spark.range(5).selectExpr("cast(id as int) a", "if(id = 3, null, cast(id as decimal(9,2))) b"), {"a": F.col("a"), "b": F.col("b")})
    found = [read(b.asDict(), ["b"])["b"].tolist() for b in blocks.collect()]
    assert sorted(str(v) for own in found for v in own) == ["0.0", "1.0", "2.0", "4.0", "nan"]


def listed(rows):
    return [tuple(r) for r in sorted(rows, key=lambda r: r[:2])]


@pytest.mark.parametrize("at_once", [1, 5000])
def test_features_in_turn_are_features_together(spark, monkeypatch, at_once):
    rng, n = np.random.default_rng(2), 3000
    y = rng.integers(0, 40, n) / 4
    rows = spark.createDataFrame([(float(a), float(b), float("nan") if b > 30 else float(c), float(v)) for a, b, c, v in zip(rng.normal(size=n), rng.integers(0, 50, n), rng.normal(size=n).round(1), y)], "a_1 double, a_2 double, b_1 double, y double").repartition(5)
    families = {"a_": ["a_1", "a_2"], "b_": ["b_1"]}
    together = listed(X.rank_scores(rows, families, "y").collect())
    moved = []
    monkeypatch.setattr(X, "written", lambda df, name, *more: moved.append(name) or W.written(df, name, *more))
    monkeypatch.setattr(X, "VALUES_AT_ONCE", at_once)
    monkeypatch.setattr(X, "VALUES_HELD", 100)
    for got, want in zip(listed(X.rank_scores(rows, families, "y").collect()), together, strict=True):
        assert got[:3] == want[:3] and got[3:] == pytest.approx(want[3:])
    assert moved.count("values") == (3 if at_once == 1 else 2)


def size(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)


@pytest.mark.parametrize("name", ["L12_feature_families", "L11_rank_information"])
def test_no_table_of_features_is_stored(spark, monkeypatch, name):
    names = []
    for module in (W, X, T):
        monkeypatch.setattr(module, "written", lambda df, name, *more, own=W.written: names.append(name) or own(df, name, *more))
    before = size(W.shared_dir(spark))
    registry.QUERIES[name](spark, DATA)
    assert sorted(set(names)) == ["candles", "counts", "values"]  # features were written once or twice
    assert size(W.shared_dir(spark)) == before  # and stayed


def test_shuffle_files_go_when_a_query_ends(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for top in env.localDirs() for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}
    before = files()
    with W.brief_shuffles(spark):
        assert spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") != "true"


def test_unit_prices_are_not_moved(spark):
    text = P.supplier_candles(spark, DATA, ["symbol"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in text and " / " not in text.split("RepartitionByExpression")[1]  # a quotient of two columns that are moved anyway


def test_labelled_rows_are_those_of_tables(spark):
    candles = odd_candles(spark).where("open is null or open <> 0")  # SQL may not divide by 0
    features = [c for c in (*T.PRICES, *T.INDICATORS) if c not in ("volatility_1_steps_1d", "sharpe_1_steps_1d", "rsi_1d") and not c.endswith(("_1y", "_6m"))]  # rows of both kinds have the others
    table = T.append_future_returns(T.candles_daily(candles, None), 5, [0.05], ["down", "flat", "up"]).where("future_class is not null")
    table = L.finite_rows(L.time_split(table).select(*features, "future_class", "is_test"))
    rows = T.labelled_rows(T.candle_blocks(candles.repartition(3, "symbol")), features, 5, 0.05, ["down", "flat", "up"], 365)
    listed = lambda df: sorted(tuple(repr(round(v, 9) + 0.0) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert listed(rows) == listed(table) and {r.is_test for r in table.collect()} == {True, False}


def test_a_grid_stores_bins_only(spark, monkeypatch):
    names = []
    for module in (W, trees, T):
        monkeypatch.setattr(module, "written", lambda df, name, *more, own=W.written: names.append(name) or own(df, name, *more))
    registry.QUERIES["L6_tree_grid"](spark, DATA)
    assert sorted(set(names)) == ["binned", "candles"]  # rows of doubles were written first, keyed candles too


def test_a_grid_of_nothing(spark):
    rows = spark.createDataFrame([(1.0, "x", True)], "a double, y string, held boolean")
    assert trees.split_grid(rows.limit(0), "held", ["a"], "y", {}).count() == 0 and trees.split_grid(rows, "held", ["a"], "y", {}).count() == 0
