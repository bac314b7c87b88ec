"""Registered queries: a callable (spark, sf_dir) -> DataFrame and, where SQL can say it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def grid(x: Column, digits: int = 4) -> Column:
    """x on a grid, by the same arithmetic as ``sql_grid``; null for NaN and infinities."""
    scale = float(10**digits)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.floor(x * scale + 0.5).cast("double") / scale)


def sql_grid(x: str, digits: int = 4) -> str:
    scale = f"1e{digits}"
    return f"(CASE WHEN isfinite({x}) THEN floor(({x}) * {scale} + 0.5) / {scale} END)"


CANDLES = """candles AS (
  SELECT l_suppkey AS symbol, l_shipdate::DATE AS timeframe, min_by(px, k) AS open, max_by(px, k) AS close, max(px) AS high, min(px) AS low, sum(l_quantity) AS volume
  FROM (SELECT *, l_extendedprice / l_quantity AS px, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_extendedprice, 'e': l_quantity} AS k FROM lineitem)
  GROUP BY 1, 2)"""

EVENT_CANDLES = """event_candles AS (
  SELECT user_id AS symbol, date_trunc('{unit}', ts) AS timeframe, min_by(value, k) AS open, max_by(value, k) AS close, max(value) AS high, min(value) AS low, count(*) AS volume
  FROM (SELECT *, {{'a': ts, 'b': event_id}} AS k FROM events) GROUP BY 1, 2)"""

FILINGS = """filings_raw AS (
  SELECT l_suppkey AS cik, 'shares' AS metric, (date_trunc('quarter', l_shipdate::DATE) + INTERVAL 3 MONTH)::DATE - 1 AS period_end, sum(l_quantity)::BIGINT AS value FROM lineitem GROUP BY ALL
  UNION ALL
  SELECT l_suppkey, 'float', last_day(make_date(year(l_shipdate), CASE WHEN month(l_shipdate) <= 6 THEN 6 ELSE 12 END, 1)), floor(sum(floor(l_extendedprice)))::BIGINT FROM lineitem GROUP BY ALL
  UNION ALL
  SELECT l_suppkey, 'earnings', make_date(year(l_shipdate), 12, 31), (sum(floor(l_extendedprice)) - 30 * sum(floor(l_quantity * 50)))::BIGINT FROM lineitem GROUP BY ALL),
filings AS (SELECT cik, metric, period_end, (period_end + (20 + cik % 60)::INTEGER)::DATE AS filed, value FROM filings_raw)"""

AS_OF = "2002-06-30"

# valid ranges of one metric, and padded to days
def ranges_sql(metric: str, source: str = "filings") -> str:
    return f"""(SELECT *, coalesce((lead(filed) OVER (PARTITION BY cik ORDER BY filed) - 1)::DATE, DATE '{AS_OF}') AS valid_until FROM (
      SELECT * FROM {source} WHERE metric = '{metric}' AND filed <= DATE '{AS_OF}'
      QUALIFY row_number() OVER (PARTITION BY cik, filed ORDER BY period_end DESC) = 1))"""


def padded_sql(source: str = "filings") -> str:
    one = lambda m: f"(SELECT cik, d::DATE AS reference_date, value AS v, filed FROM {ranges_sql(m, source)}, generate_series(filed, valid_until, INTERVAL 1 DAY) AS g(d))"
    return f"""padded AS (
  SELECT cik, reference_date, s.v AS shares, f.v AS float, e.v AS earnings, greatest(s.filed, f.filed, e.filed) AS last_filed
  FROM {one('shares')} s FULL JOIN {one('float')} f USING (cik, reference_date) FULL JOIN {one('earnings')} e USING (cik, reference_date))"""


IMPLIED = """implied AS (
  SELECT f.cik, f.metric, f.period_end, f.filed, CASE WHEN f.metric <> 'float' THEN f.value::DOUBLE ELSE f.value / c.open END AS value
  FROM filings f LEFT JOIN candles c ON c.symbol = f.cik AND c.timeframe = f.period_end)"""

STOCKS = """stocks AS (
  SELECT c.symbol, c.timeframe, c.open, c.close, c.high, c.low, c.volume, p.shares, p.float, p.earnings, p.shares * c.open AS market_cap,
    p.shares * c.open / p.earnings AS price_to_earnings, p.float * c.open AS float_cap, p.earnings / p.shares AS earnings_per_share
  FROM candles c LEFT JOIN padded p ON p.cik = c.symbol AND p.reference_date = c.timeframe)"""

RANKINGS = """rankings AS (
  SELECT symbol, timeframe, market_cap, row_number() OVER (PARTITION BY timeframe ORDER BY market_cap DESC, symbol)::INTEGER AS rank FROM stocks WHERE market_cap > 0)"""


def with_stocks() -> str:
    return ", ".join([CANDLES, FILINGS, IMPLIED, padded_sql("implied"), STOCKS, RANKINGS])


RETURNS = """returns AS (
  SELECT *, CASE WHEN close > 0 AND prev > 0 THEN ln(close / prev) END AS log_return_1d FROM (
    SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY timeframe) AS prev FROM candles))"""
