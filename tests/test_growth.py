"""Plans and results that decide how a query grows with its tables."""

from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quantloom.operators import features as X
from quantloom.operators import portfolio as B
from quantloom.operators import vgraph as G
from quantloom.plans import core_queries, registry, table_checks
from quantloom.plans import tables as T
from quantloom.sources import panels as P
from quantloom.sources import writers as W

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def listed(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


FILED = "cik long, metric string, period_end date, filed date, value double"


def test_padded_days_are_not_moved(spark):
    top = plan(registry.QUERIES["M5_padded_facts"](spark, DATA)).split("Generate")[0]
    assert "Exchange" not in top and "Join" not in top
    survive = plan(registry.QUERIES["Q18_filings_survive_padding"](spark, DATA))
    assert "Broadcast" not in survive  # padded days were once sent to the driver


def test_stocks_by_ranges_are_those_by_days(spark):
    day = lambda n: date(2020, 1 + n // 28, 1 + n % 28)
    filings = [(1, "shares", day(0), day(5), 10.0), (1, "shares", day(1), day(5), 11.0), (1, "float", day(2), day(40), None), (1, "shares", day(30), day(70), 12.0), (2, "earnings", day(3), day(9), 4.0), (2, "other", day(3), day(20), 5.0), (None, "shares", day(0), day(4), 1.0), (None, "float", day(0), day(4), 2.0)]
    filings = spark.createDataFrame(filings, FILED)
    candles = spark.createDataFrame([(s, day(n), float(n)) for s in (1, 2, 3, None) for n in range(0, 110, 3)], "symbol long, timeframe date, open double")
    until = F.lit(day(100)).cast("date")
    padded = T.padded_facts(filings, until)
    assert listed(T.stocks_daily_ranges(candles, T.fact_ranges(filings, until))) == listed(T.stocks_daily(candles, padded))
    assert padded.where("cik is null").count() == 2 * 104  # facts without a company don't meet
    assert padded.where("cik = 1 and reference_date = date'2020-01-06'").first().shares == 11.0
    assert padded.where("cik = 1 and float is not null").count() == 0 and padded.where("cik = 2").count() == 99


GRAPHS = ("G3_density", "G4_clustering", "G5_assortativity", "G6_power_law", "G7_path_measures", "M15_visibility_measures", "M15b_gold_visibility_view")


@pytest.mark.parametrize("name", GRAPHS)
def test_edges_of_graphs_are_not_rows(spark, name):
    text = plan(registry.QUERIES[name](spark, DATA))
    assert text.count("Exchange") <= 2 and "Join" not in text  # candles, then graphs


def test_measures_of_graph_rows_are_those_of_edges(spark):
    rng, nan, inf = np.random.default_rng(5), float("nan"), float("inf")
    shapes = [rng.random(n).round(1).tolist() for n in (2, 3, 5, 9, 31, 31, 70)] + [[1.0] * 12, [1.0, None, 3.0, 2.0, None], [nan, 1.0, 2.0, nan, 5.0], [inf, 1.0, -inf, inf, 2.0, 2.0], [7.0]]
    rows = [(date(2020, 1, 31), g, date(2020, 1, 1) + timedelta(days=i), v) for g, own in enumerate(shapes) for i, v in enumerate(own)]
    rows = spark.createDataFrame(rows, "window_end date, symbol long, timeframe date, open double")
    points = G.graph_points(rows)
    old, new = (df.orderBy("symbol").toPandas() for df in (G.visibility_measures(points, G.visibility_edges(points)), G.graph_measures(G.graph_rows(rows))))
    assert list(old.columns) == list(new.columns) and len(old) == len(shapes) - 1
    for c in G.MEASURES:
        assert old[c].isna().tolist() == new[c].isna().tolist()
        assert np.allclose(old[c].to_numpy(float), new[c].to_numpy(float), rtol=1e-12, atol=1e-12, equal_nan=True), c


@pytest.mark.parametrize("name", ["V5_M13_embeddings", "V6_aligned_embeddings", "Q22_adjacent_cosine"])
def test_embeddings_are_made_once(spark, name):
    assert "lineitem" not in plan(registry.QUERIES[name](spark, DATA))  # what is read again was written


def test_wide_tables_have_few_columns_and_all_symbols(spark, tmp_path):
    rows = spark.range(500).selectExpr("id * 37 - 1000 AS user_id", "id AS event_id", "timestamp'2024-01-01 10:00:00' AS ts", "double(id) AS value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = registry.QUERIES["S13_wide_to_long"](spark, str(tmp_path))
    assert plan(got).count("_open") < 2000  # once a name for every symbol
    assert sorted((r.symbol, r.field, r.v) for r in got.collect()) == sorted((i * 37 - 1000, f, float(i)) for i in range(500) for f in ("open", "close", "high", "low"))


def test_arrays_of_floats_as_sql(spark, tmp_path):
    import duckdb

    every = [[float(np.float32(i / 1000))] * 4 for i in range(1, 4000)] + [[], [None, 0.5], None]
    spark.createDataFrame(list(enumerate(every)), "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = sorted((tuple(r) for r in registry.QUERIES["F8_arrays"](spark, str(tmp_path)).select("vec_id", "n", "head", "part").collect()), key=lambda r: r[0])
    assert got == sorted(con.execute(f"SELECT vec_id, n, head, part FROM ({registry.SQL['F8_arrays']})").fetchall(), key=lambda r: r[0])


def test_rolled_by_blocks_is_rolled_by_windows():
    rng = np.random.default_rng(3)
    for size in (1, 2, 7, 100, 530):
        x, there = np.exp(rng.normal(size=size).cumsum()), rng.random(size) > 0.2
        for n in T.LOOKBACKS:
            for spread in (False, True):
                with np.errstate(all="ignore"):
                    assert np.allclose(T._rolled(x, there, n, spread), T._rolled_each(x, there, n, spread), rtol=1e-11, atol=0, equal_nan=True)
    assert (T._rolled(np.full(40, 0.1), np.ones(40, bool), 5, True)[1:] == 0).all()
    far = np.array([1e200, 1.0, 1.0, 1.0, 2.0, 3.0])
    assert T._rolled(far, np.ones(6, bool), 3, True)[5] == 1.0 and T._rolled(far, np.ones(6, bool), 3)[3] == 1.0


def test_momentum_makes_no_row_for_a_symbol_and_window(spark):
    """A task holds the best symbols of each window; ties, nulls, NaN and a null symbol rank as in a plain sort."""
    rng, nan, inf = np.random.default_rng(11), float("nan"), float("inf")
    day = lambda n: date(2020, 1, 1) + timedelta(days=int(n))
    odd = [None, nan, 0.0, -1.0, inf, 1.0, 2.0, 2.0, 4.0]
    rows = [(s if s else None, day(n), odd[rng.integers(9)] if rng.random() < 0.4 else float(rng.integers(1, 5))) for s in range(60) for n in np.flatnonzero(rng.random(300) < 0.1)]
    rows.append((3, None, 9.0))
    candles = spark.createDataFrame(rows, "symbol long, timeframe date, close double")
    rebalances = [(m, w, day(n)) for m in (1, 3) for w in (0, 2) for n in (0, 95, 180, 200, 299)]
    table = spark.createDataFrame(rebalances, "months int, weeks int, rebalance date")
    choice = B.momentum_choice(candles, table, F.col("months"), F.col("weeks"), 7, ["months", "weeks"])
    assert "Generate" not in plan(choice) and "HashAggregate" not in plan(choice)
    expected = []
    for m, w, r in rebalances:
        a, b = spark.sql(f"SELECT add_months(date'{r}', -{m}), date_sub(date'{r}', {7 * w})").first()
        found = []
        for s in {x[0] for x in rows}:
            own = sorted((x[1], x[2]) for x in rows if x[0] == s and x[1] is not None and a <= x[1] <= b)
            if own and own[0][1] is not None and not own[0][1] <= 0:
                start, stop = own[0][1], own[-1][1]
                rise = None if stop is None else stop / start - 1
                found.append(((2 if rise is None else 0 if rise != rise else 1), -rise if rise is not None and rise == rise else 0.0, s is not None, s or 0, rise))
        expected += [(m, w, r, x[3] if x[2] else None, x[4], i + 1) for i, x in enumerate(sorted(found)[:7])]
    assert repr(listed(choice)) == repr(sorted(expected, key=repr)) and len(expected) > 60


def test_symbols_are_cut_whole():
    rows = pa.table({"symbol": pa.array([None, None, 1, 2, 2, 2, 2, 3, 4, 4, 5], pa.int64()), "n": range(11)})
    for most in (1, 2, 9):
        for at_once in (1, 4, 100):
            blocks = list(B._symbols(iter(rows.to_batches(max_chunksize=2)), most, at_once))
            assert pa.concat_tables([b[2] for b in blocks]).to_pydict() == rows.to_pydict()
            assert [s for names, _, _ in blocks for s in names.to_pylist()] == [None, 1, 2, 3, 4, 5]
            assert all(names.take(pa.array(number)).to_pylist() == own["symbol"].to_pylist() and len(names) <= most for names, number, own in blocks)


def test_futures_of_candles_take_one_shuffle_and_sort(spark):
    text = plan(T.append_future_returns(core_queries.symbol_candles(spark, DATA), 5))
    assert text.count("Exchange") == 1 and text.count(" Sort ") == 1


def test_distinct_values_are_written_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(X, "written", lambda df, name, *more: seen.append(name) or W.written(df, name, *more))
    X.rank_scores(spark.range(50).selectExpr("double(id) AS x", "double(id % 7) AS y"), {"all": ["x"]}, "y")
    assert sorted(seen) == ["counts", "features", "values"]  # counts and values were made three times


@pytest.mark.parametrize("table", ["stocks_daily", "stocks_rankings", "training_rows", "good_symbols"])
def test_checks_and_their_foreign_keys_read_what_was_written_once(spark, table):
    own, known = table_checks.checked(spark, DATA, table)
    assert known and not any("lineitem" in plan(x) for x in (own, *known.values()))  # both made all stocks on their own


def test_implied_floats_make_candles_of_half_years_only(spark):
    scans = [x for x in plan(core_queries.priced_filings(spark, DATA)).split("\n") if "lineitem" in x and "PushedFilters" in x]
    text = core_queries.priced_filings(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("last_day(cast(l_shipdate") >= 1 and scans
    every = T.implied_float_shares(P.filings(spark, DATA), core_queries.candles(spark, DATA))
    assert listed(core_queries.priced_filings(spark, DATA)) == listed(every)


def test_rolled_tables_follow_from_what_was_written_once(spark):
    assert "lineitem" not in plan(registry.QUERIES["Q15_roll_up"](spark, DATA))  # lineitems were read by each report on its own


def test_checks_of_padded_facts_move_no_day(spark):
    lines = plan(registry.QUERIES["Q15_checks_padded_facts"](spark, DATA)).split("\n")
    made = [i for i, x in enumerate(lines) if "Generate explode(" in x and "sequence(valid_from" in x]
    assert made and not any("HashAggregate(keys=[cik" in x and "reference_date" in x for x in lines)  # days were grouped by company and day


def test_filings_read_lineitems_once(spark):
    text = plan(P.filings(spark, DATA))
    assert text.split("== Initial Plan ==")[0].count("FileScan parquet") == 1


def test_documents_are_parsed_once(spark):
    text = registry.QUERIES["S5_M4_company_facts"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_caps_by_months_are_those_of_stocks(spark):
    caps = core_queries.capped(spark, DATA)
    assert listed(T.stocks_rankings(caps)) == listed(T.stocks_rankings(core_queries.stocks(spark, DATA)))
    assert listed(caps.select("symbol", "timeframe", "close")) == listed(core_queries.candles(spark, DATA).select("symbol", "timeframe", "close"))
    whole = plan(caps).split("== Initial Plan ==")[0]
    assert whole.count("hashpartitioning(symbol") == 1  # candles meet facts where lineitems were dealt
