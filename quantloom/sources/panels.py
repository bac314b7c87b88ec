"""Panels derived from the base tables: candles, filings, factors and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HALF_YEAR = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_candles(spark: SparkSession, sf_dir: str, dealt_by: Sequence[str] = ("symbol", "timeframe")) -> DataFrame:
    """Daily candles of each supplier's unit prices: symbol, timeframe, open, close, high, low, volume.

    A candle has hardly more than one row, so rows are dealt before they are sorted and added up, once. A query that brings a
    symbol's candles into one task in any case deals by ``symbol`` and saves its own shuffle and sort; one that joins by symbol and
    ``month`` deals by both, and its candles have a column more, the first day of their month.
    """
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("timeframe"))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rows = rows.withColumn("month", F.trunc("timeframe", "month"))
    keys = list(dict.fromkeys([*dealt_by, "symbol", "timeframe"]))
    dealt = rows.repartition(*dealt_by).withColumn("px", F.col("l_extendedprice") / F.col("l_quantity"))  # follows from what is moved
    found = dealt.groupBy(*keys).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.max("px").alias("high"), F.min("px").alias("low"), F.sum("l_quantity").alias("volume"))
    price = lambda at: (F.col(f"{at}.l_extendedprice") / F.col(f"{at}.l_quantity"))
    return found.select(*keys, price("first").alias("open"), price("last").alias("close"), "high", "low", "volume")


def event_candles(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    """Candles of each user's event values per day or hour."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("timeframe"), "value", F.struct("ts", "event_id").alias("k"))
    return rows.groupBy("symbol", "timeframe").agg(F.min_by("value", "k").alias("open"), F.max_by("value", "k").alias("close"), F.max("value").alias("high"), F.min("value").alias("low"), F.count(F.lit(1)).alias("volume"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse company filings: cik, metric, period_end, filed, value. Shares per quarter, float per half-year, earnings per year.

    Rows are read once and added up by quarter; half-years and years are added up from their quarters, in whole numbers.
    """
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("cik"), F.col("l_shipdate").cast("date").alias("day"), "l_quantity", "l_extendedprice", "l_discount")
    quarter_end = F.date_sub(F.add_months(F.trunc("day", "quarter"), 3).cast("date"), 1)
    whole = [F.sum("l_quantity").cast("long").alias("shares"), F.sum(F.floor("l_extendedprice")).alias("price"), F.sum(F.floor(F.col("l_quantity") * 50)).alias("cost")]
    quarters = rows.groupBy("cik", quarter_end.alias("end")).agg(*whole)
    half = F.make_date(F.year("end"), F.when(F.month("end") <= HALF_YEAR, 6).otherwise(12), F.lit(1))
    ends = {"shares": (F.col("end"), "shares"), "float": (F.last_day(half), "price"), "earnings": (F.make_date(F.year("end"), F.lit(12), F.lit(31)), "price")}
    entries = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), end.alias("period_end"), F.col(x).alias("value"), F.col("cost").alias("cost")) for m, (end, x) in ends.items()]))
    total = F.sum("value") - F.when(F.col("metric") == "earnings", F.lit(30) * F.sum("cost")).otherwise(0)
    every = quarters.select("cik", entries.alias("e")).select("cik", "e.*").groupBy("cik", "metric", "period_end").agg(total.alias("value"))
    lag = (F.lit(20) + F.col("cik") % 60).cast("int")
    return every.select("cik", "metric", "period_end", F.date_add("period_end", lag).alias("filed"), "value")


def factors(spark: SparkSession, sf_dir: str, candles: DataFrame) -> DataFrame:
    """Daily factors from candles with log_return_1d: timeframe, mkt_rf, smb, hml, rf."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), "s_acctbal")
    r = candles.where("log_return_1d is not null").join(supplier, "symbol")
    part = lambda c: F.coalesce(F.avg(F.when(c, F.col("log_return_1d"))), F.lit(0.0))
    even, rich = F.col("symbol") % 2 == 0, F.col("s_acctbal") > 0
    return r.groupBy("timeframe").agg(F.avg("log_return_1d").alias("mkt_rf"), (part(even) - part(~even)).alias("smb"), (part(rich) - part(~rich)).alias("hml")).withColumn("rf", F.lit(0.0001))
