"""The check list of each table, as data: one declaration makes the Spark check and the SQL that counts its violations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as Q
from ..sources import panels as P
from ..sources import readers as R
from ..sources.writers import written
from . import core_queries, more_queries  # noqa: F401  the tables
from . import tables as T
from .registry import AS_OF, QUERIES, SQL, query

PRICES = ("open", "close", "high", "low", "volume")
STRENGTHS = ("rsi", "rsi_1d", "rsi_1w", "rsi_1m", "rsi_1q", "rsi_6m", "rsi_1y")
FACTORS = ("mkt_rf", "smb", "hml", "rmw", "cma", "rf")
LOADINGS = ("alpha", "beta_mkt_rf", "beta_smb", "beta_hml")

# fixed values: what each table must hold, and the query that makes the table
TABLES = {"candles_daily": "M1_candles_daily", "company_tickers": "S4_M2_company_tickers", "factors": "S3_S18_M3_factor_csv", "factor_loadings": "V9_M14_factor_loadings", "good_symbols": "M8_good_symbols", "company_facts": "S5_M4_company_facts", "padded_facts": "M5_padded_facts", "stocks_daily": "M6_stocks_daily", "stocks_rankings": "M7_stocks_rankings", "symbol_embeddings": "V5_M13_embeddings", "training_rows": "M12_training_rows", "gold_stocks_daily": "M6b_stocks_daily_asof", "indicator_catalogue": "M10_indicator_catalogue", "visibility_graphs": "M15_visibility_measures", "gold_visibility_graphs": "M15b_gold_visibility_view"}
LISTS: dict[str, list[tuple]] = {
    "candles_daily": [("not_empty",), ("not_null", "timeframe", "symbol"), ("unique", "timeframe", "symbol"), ("compare", "low", "<=", "high"), *[("in_range", c, 0, 100) for c in STRENGTHS], ("fresh", "timeframe", 3)],
    "company_tickers": [("not_empty",), ("not_null", "cik", "ticker"), ("unique", "cik", "ticker"), ("unique", "ticker"), ("matches", "ticker", r"[A-Za-z0-9.\-]+")],
    "factors": [("not_empty",), ("unique", "region", "timeframe"), ("finite", *FACTORS), ("not_null", "timeframe", "region", *FACTORS), ("no_gaps", "timeframe", "region", True)],
    "factor_loadings": [("not_empty",), ("not_null", "window_end", "symbol", *LOADINGS), ("finite", *LOADINGS), ("unique", "window_end", "symbol")],
    "good_symbols": [("not_empty",), ("not_null", "timeframe", "symbol"), ("unique", "timeframe", "symbol"), ("foreign", ("timeframe", "symbol"), "stocks_daily")],
    "company_facts": [("not_empty",), ("finite", "value"), ("not_null", "cik", "metric"), ("accepted", "metric", "shares", "float")],
    "padded_facts": [("not_empty",), ("not_null", "cik", "reference_date", "last_filed"), ("not_null", "earnings"), ("unique", "cik", "reference_date"), ("compare", "reference_date", ">=", "last_filed"), ("no_gaps", "reference_date", "cik", False)],
    "stocks_daily": [("not_empty",), ("not_null", "timeframe", "symbol"), ("unique", "timeframe", "symbol"), ("fresh", "timeframe", 3), ("finite", "price_to_earnings", "earnings_per_share"), ("foreign", ("timeframe", "symbol"), "stocks_rankings")],
    "stocks_rankings": [("not_empty",), ("not_null", "timeframe", "symbol", "rank"), ("unique", "timeframe", "symbol"), ("in_range", "rank", 1, 40), ("foreign", ("timeframe", "symbol"), "good_symbols")],
    "symbol_embeddings": [("not_empty",), ("not_null", "window_end", "symbol", "embedding"), ("unique", "window_end", "symbol"), ("length", "embedding", 16)],
    "training_rows": [("not_empty",), ("not_null", "timeframe", "symbol", "embedding_0", "open", "market_cap"), ("finite", "open", "market_cap"), ("unique", "timeframe", "symbol"), ("compare", "open", "<=", "market_cap"), ("no_negative", "open"), ("fresh", "timeframe", 3), ("foreign", ("timeframe", "symbol"), "good_symbols")],
    "gold_stocks_daily": [("not_empty",), ("not_null", "timeframe", "symbol"), ("unique", "timeframe", "symbol"), *[("no_negative", c) for c in PRICES]],
    "indicator_catalogue": [("not_empty",), ("not_null", "namespace", "indicator"), ("unique", "namespace", "indicator")],
    "visibility_graphs": [("not_empty",), ("in_range", "density", 0, 1), ("in_range", "clustering", 0, 1)],
    "gold_visibility_graphs": [("not_empty",)],
}


def name_of(spec: tuple) -> str:
    return " ".join(" ".join(x) if isinstance(x, tuple) else str(x) for x in spec)


def checked(s, d, table: str) -> tuple[DataFrame, Mapping[str, DataFrame]]:
    """The table, and those of its foreign keys that follow from the same rows; these rows are made and written once."""
    make = lambda name: QUERIES[TABLES[name]](s, d)
    if table in ("stocks_daily", "good_symbols"):
        own, named = make("stocks_daily"), {str(x) for spec in LISTS["stocks_daily"] for x in spec}
        stocks = written(own.select(*[c for c in own.columns if c in named or c in ("symbol", "timeframe", "market_cap")]), "stocks")
        rankings = T.stocks_rankings(stocks)
        return (stocks, {"stocks_rankings": rankings}) if table == "stocks_daily" else (T.good_symbols(rankings, 20), {"stocks_daily": stocks})
    if table == "stocks_rankings":
        return ranked(written(core_queries.capped(s, d), "caps"))
    if table == "training_rows":
        valued, universe = core_queries.valued_universe(s, d)
        return core_queries.training(valued, universe), {"good_symbols": universe}
    return make(table), {}


def ranked(caps: DataFrame) -> tuple[DataFrame, Mapping[str, DataFrame]]:
    """Rankings, and the good symbols of each day, which are few and are sent to all tasks: ranks stay in their day's task when they are grouped."""
    rankings = T.stocks_rankings(caps)
    return rankings, {"good_symbols": F.broadcast(written(T.good_symbols(rankings, 20), "good_symbols"))}


def as_check(spec: tuple, s, d, known: Mapping[str, DataFrame] = {}) -> Q.Check:
    kind, args = spec[0], spec[1:]
    if kind == "fresh":
        return Q.freshness(*args, F.lit(AS_OF).cast("date"))
    if kind == "accepted":
        return Q.accepted_values(args[0], args[1:])
    if kind == "foreign":
        return Q.foreign_key(args[0], known[args[1]] if args[1] in known else QUERIES[TABLES[args[1]]](s, d))
    if kind == "no_gaps":
        return Q.no_gaps(args[0], [args[1]], args[2])
    make = {"not_empty": Q.not_empty, "not_null": Q.not_null, "unique": Q.unique, "compare": Q.column_comparison, "in_range": Q.in_range, "matches": Q.matches, "finite": Q.finite, "length": Q.list_length, "no_negative": Q.no_negative}
    return make[kind](*args)


def as_sql(spec: tuple) -> str:
    """A scalar query over ``t``."""
    kind, args = spec[0], spec[1:]
    count = lambda condition: f"SELECT count(*) FROM t WHERE {condition}"
    if kind == "not_empty":
        return "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM t"
    if kind == "not_null":
        return count(" OR ".join(f"{c} IS NULL" for c in args))
    if kind == "unique":
        return f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM t GROUP BY {', '.join(args)} HAVING count(*) > 1)"
    if kind == "compare":
        return count(f"NOT {args[0]} {args[1]} {args[2]}")
    if kind == "in_range":
        return count(f"{args[0]} < {args[1]} OR {args[0]} > {args[2]}")
    if kind == "matches":
        return count(f"NOT regexp_full_match({args[0]}, '{args[1]}')")
    if kind == "finite":
        return count(" OR ".join(f"NOT isfinite({c}::DOUBLE)" for c in args))
    if kind == "no_negative":
        return count(f"{args[0]} < 0")
    if kind == "fresh":
        return f"SELECT CASE WHEN DATE '{AS_OF}' - max({args[0]})::DATE > {args[1]} THEN 1 ELSE 0 END FROM t"
    if kind == "accepted":
        return count(f"{args[0]} NOT IN ({', '.join(repr(v) for v in args[1:])})")
    if kind == "foreign":
        return f"SELECT count(*) FROM t WHERE NOT EXISTS (SELECT 1 FROM ({SQL[TABLES[args[1]]]}) u WHERE {' AND '.join(f'u.{c} = t.{c}' for c in args[0])})"
    day, by, weekdays = args  # no_gaps
    inside = "WHERE isodow(x) <= 5" if weekdays else ""
    return f"SELECT count(*) FROM (SELECT {by}, x::DATE AS day FROM (SELECT {by}, min({day}) AS a, max({day}) AS z FROM t GROUP BY 1), generate_series(a, z, INTERVAL 1 DAY) AS g(x) {inside}) e WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.{by} = e.{by} AND t.{day} = e.day)"


def listed_report(s, d, table: str, own: DataFrame, known: Mapping[str, DataFrame] = {}, ranges: Q.Ranges | None = None) -> DataFrame:
    return Q.report(own, {name_of(x): as_check(x, s, d, known) for x in LISTS[table]}, ranges)


def ranges_of(filings: DataFrame) -> DataFrame:
    return written(T.fact_ranges(filings, core_queries.as_of()), "ranges")


def days_report(s, d, ranges: DataFrame) -> DataFrame:
    """The list of padded facts, by the ranges that their days are made of."""
    return listed_report(s, d, "padded_facts", T.padded_ranges(ranges), ranges=Q.Ranges(ranges, "valid_from", "valid_until", "reference_date"))


def table_report(s, d, table: str) -> DataFrame:
    if table == "padded_facts":
        return days_report(s, d, ranges_of(P.filings(s, d)))
    own, known = checked(s, d, table)
    return listed_report(s, d, table, own, known)


def report_sql(table: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{name_of(x)}' AS \"check\", ({as_sql(x)})::BIGINT AS violations" for x in LISTS[table])
    return f"WITH t AS MATERIALIZED ({SQL[TABLES[table]]}) {rows}"


for _table in TABLES:
    query(f"Q15_checks_{_table}", report_sql(_table) if TABLES[_table] in SQL else None)(lambda s, d, table=_table: table_report(s, d, table))

ROLLED = ("company_tickers", "factors", "company_facts", "padded_facts", "stocks_rankings", "indicator_catalogue")


def rolled_sources(s, d) -> dict[str, DataFrame]:
    """What several of the rolled tables follow from, written once: company documents, ranges of facts, and candles with their caps."""
    filings = written(P.filings(s, d), "filings")
    ranges = ranges_of(filings)
    return {"documents": written(more_queries.company_documents(filings), "documents"), "ranges": ranges, "candles": written(core_queries.capped(s, d, ranges), "candles")}


def rolled_report(s, d, table: str, made: Mapping[str, DataFrame]) -> DataFrame:
    if table == "padded_facts":
        return days_report(s, d, made["ranges"])
    if table == "stocks_rankings":
        return listed_report(s, d, table, *ranked(made["candles"]))
    if table == "factors":
        return listed_report(s, d, table, more_queries.factor_file(s, more_queries.factor_table(s, d, core_queries.with_returns(made["candles"]))))
    if table == "company_facts":
        return listed_report(s, d, table, more_queries.company_facts(R.parse_facts(made["documents"])))
    if table == "indicator_catalogue":
        return listed_report(s, d, table, R.indicator_catalogue(R.parse_facts(made["documents"])))
    return table_report(s, d, table)


@query("Q15_roll_up", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS checks, count(*) FILTER (violations > 0) AS failed, sum(violations)::BIGINT AS violations FROM ({report_sql(t)})" for t in ROLLED))
def roll_up(s, d):
    made = rolled_sources(s, d)
    return Q.roll_up({t: rolled_report(s, d, t, made) for t in ROLLED})
