"""Momentum portfolios as set-based jobs: calendars, choices, closed-form equity curves, metrics, adaptive choice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import days_between, ieee_div, median_price, period_key, quantised

Rule = Callable[[DataFrame, DataFrame], DataFrame]
TRADING_DAYS = 252
_FAR = 1 << 32  # more days than any date is from another
# fixed values: the combinations that the adaptive choice tries
ADAPTIVE_GRID = {"months": (3, 9, 12), "weeks": (2, 4), "tops": (10, 20, 30), "frequencies": ("weekly", "monthly", "quarterly")}


def rebalance_days(candles: DataFrame, frequency: str = "monthly", months: int = 6, ignore_weeks: int = 1) -> DataFrame:
    """(rebalance): the first trading day of each period after the warm-up."""
    days = candles.select("timeframe").distinct()
    first = days.agg(F.date_add(F.add_months(F.min("timeframe"), months), 7 * ignore_weeks).alias("__from"))
    return days.join(F.broadcast(first), F.col("timeframe") >= F.col("__from")).groupBy(period_key(F.col("timeframe"), frequency).alias("p")).agg(F.min("timeframe").alias("rebalance")).select("rebalance")


def momentum_choice(candles: DataFrame, rebalances: DataFrame, months: int | Column = 6, ignore_weeks: int | Column = 1, top: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, rebalance, symbol, momentum, place): the symbols whose close rose most over the closed window before each day; ties by symbol.

    ``rebalances`` is a calendar, so it is bounded by the days covered, and its windows are sent to the tasks. Candles are dealt and
    sorted by symbol; a task looks up both ends of every window in its symbols' days and holds the best ``top`` of each window
    so far, so no row is made for a symbol and window, and what is moved afterwards doesn't grow with symbols.
    """
    months, weeks = (x if isinstance(x, Column) else F.lit(x) for x in (months, ignore_weeks))
    spans = rebalances.select(*keys, "rebalance", F.add_months("rebalance", -months).alias("__a"), F.date_sub("rebalance", (7 * weeks).cast("int")).alias("__b")).where("__a <= __b")
    rows = candles.where("timeframe is not null").select("symbol", F.col("timeframe").cast("date").alias("timeframe"), F.col("close").cast("double").alias("close"))
    dealt = rows.repartition("symbol").sortWithinPartitions("symbol", "timeframe")
    schema = T.StructType([*spans.select(*keys, "rebalance").schema.fields, rows.schema["symbol"], T.StructField("start", T.DoubleType()), T.StructField("stop", T.DoubleType())])
    ends = dealt.mapInArrow(_best_of(spans.toArrow(), top, schema.names), schema)
    w = Window.partitionBy(*keys, "rebalance").orderBy(F.desc("momentum"), "symbol")
    return ends.withColumn("momentum", F.col("stop") / F.col("start") - 1).withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(*keys, "rebalance", "symbol", "momentum", "place")


def _symbols(batches: Iterator[pa.RecordBatch], most: int, rows_at_once: int = 1 << 17) -> Iterator[tuple[pa.Array, np.ndarray, pa.Table]]:
    """Whole symbols of sorted batches, up to ``most`` at a time: their names, each row's number among them, the rows."""
    held: list[pa.RecordBatch] = []
    size = 0

    def cut(whole: bool) -> Iterator[tuple[pa.Array, np.ndarray, pa.Table]]:
        rows = pa.Table.from_batches(held).combine_chunks()
        names = rows["symbol"].combine_chunks()
        after, before = names[1:], names[:-1]
        other = pc.fill_null(pc.not_equal(after, before), False).to_numpy(zero_copy_only=False) | (after.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))
        number = np.concatenate([[0], np.cumsum(other)])
        full = int(number[-1]) + whole  # the last symbol may go on
        for i in range(0, full, most):
            a, b = np.searchsorted(number, [i, min(i + most, full)])
            own = number[a:b] - i
            yield names[a:b].take(pa.array(np.flatnonzero(np.diff(own, prepend=-1)))), own, rows.slice(a, b - a)
        held[:] = rows.slice(np.searchsorted(number, full)).to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows_at_once:
            yield from cut(False)
            size = 0
    if held:
        yield from cut(True)


def _best_of(spans: pa.Table, top: int, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Closes at both ends of each span for the ``top`` symbols of sorted rows (symbol, timeframe, close) that rose most in it.

    A symbol has the first close in a span, if it is above 0, and the last one. NaN stands above all numbers and null below, as in Spark.
    """
    first, last = (spans[c].cast(pa.int32()).to_numpy().astype(np.int64) for c in ("__a", "__b"))
    own, n = spans.drop_columns(["__a", "__b"]), len(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[np.ndarray] = [np.zeros((0, n)) for _ in range(4)]  # class and loss to order by, start and stop
        which, kept = np.zeros((0, n), np.int64), None
        for symbols, number, rows in _symbols(batches, max(16, (1 << 19) // n)) if n else ():
            day = rows["timeframe"].cast(pa.int32()).to_numpy().astype(np.int64)
            close, known = rows["close"].to_numpy(), pc.is_valid(rows["close"]).to_numpy()
            at, each = number * _FAR + day, np.arange(len(symbols))[:, None] * _FAR
            i, j = np.searchsorted(at, each + first), np.searchsorted(at, each + last, "right") - 1
            held = i <= j  # the symbol has a row in the span
            i, j = np.minimum(i, len(at) - 1), np.maximum(j, 0)
            with np.errstate(all="ignore"):
                start, stop, rise = close[i], close[j], close[j] / close[i] - 1
            held &= known[i] & ~(start <= 0)
            order = np.where(~held, 3.0, np.where(~known[j], 2.0, np.where(np.isnan(rise), 0.0, 1.0)))
            parts = [order, np.where(order == 1, -rise, 0.0), start, np.where(known[j], stop, np.nan)]
            names_here = symbols if kept is None else pa.concat_arrays([kept, symbols])
            both = [np.concatenate(x) for x in zip(best, parts)]
            which = np.concatenate([which, np.broadcast_to(np.arange(len(symbols))[:, None] + (0 if kept is None else len(kept)), order.shape)])
            chosen = np.lexsort((both[1], both[0]), axis=0)[:top]  # stable, so equal ones stay in order of symbols
            best, which = [np.take_along_axis(x, chosen, 0) for x in both], np.take_along_axis(which, chosen, 0)
            used, which = np.unique(which, return_inverse=True)
            which, kept = which.reshape(best[0].shape), names_here.take(pa.array(used))
        place, span = np.nonzero(best[0] < 3)
        if len(span):
            missing = best[0][place, span] == 2
            columns = [c.combine_chunks() for c in own.take(pa.array(span)).columns]
            columns += [kept.take(pa.array(which[place, span])), pa.array(best[2][place, span]), pa.array(best[3][place, span], mask=missing)]
            yield pa.RecordBatch.from_arrays(columns, list(names))

    return run


def allocate(choice: DataFrame, candles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, rebalance, symbol, price, weight): the chosen symbols that have a price on the day, in equal parts."""
    prices = candles.select("symbol", F.col("timeframe").alias("rebalance"), median_price(F.col("high"), F.col("low")).alias("price"))
    bought = choice.join(prices, ["symbol", "rebalance"]).where("price > 0")
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "rebalance"))
    return bought.select(*keys, "rebalance", "symbol", "price", (1.0 / n).alias("weight"))


def price_weights(weights: DataFrame, candles: DataFrame) -> DataFrame:
    """(rebalance, symbol, price, weight) of a rule's (rebalance, symbol, weight): those that have a price on the day, weights scaled to 1.

    Weights that are null, NaN or not above 0 buy nothing.
    """
    prices = candles.select("symbol", F.col("timeframe").alias("rebalance"), median_price(F.col("high"), F.col("low")).alias("price"))
    bought = weights.where("weight > 0 AND NOT isnan(weight)").join(prices, ["symbol", "rebalance"]).where("price > 0")
    total = F.sum("weight").over(Window.partitionBy("rebalance"))
    return bought.select("rebalance", "symbol", "price", (F.col("weight") / total).alias("weight"))


def backtest(candles: DataFrame, rule: Rule, frequency: str = "monthly", start: float = 1000.0, **warm_up: int) -> DataFrame:
    """(timeframe, value): the equity curve of a rule, (candles, rebalances) -> (rebalance, symbol, weight), over all rebalance days.

    A rule sees all candles and should look at those before each day only. A day for which it names nothing holds cash.
    """
    days = rebalance_days(candles, frequency, **warm_up)
    return equity_curve(price_weights(rule(candles, days), candles), days, candles, start)


def momentum_rule(months: int = 6, ignore_weeks: int = 1, top: int = 10) -> Rule:
    """The symbols that rose most, in equal parts."""
    return lambda candles, days: momentum_choice(candles, days, months, ignore_weeks, top).select("rebalance", "symbol", F.lit(1.0).alias("weight"))


def turnover_rule(days_back: int = 30, top: int = 10) -> Rule:
    """The symbols of largest volume in the days before each rebalance, by volume; ties by symbol.

    Candles are added up by day first and meet the rebalances of the days to come, so none meets a calendar's every day.
    """

    def choose(candles: DataFrame, rebalances: DataFrame) -> DataFrame:
        ahead = F.explode(days_between(F.date_add("timeframe", 1), F.date_add("timeframe", days_back)))
        traded = candles.where("volume > 0").select("symbol", "volume", ahead.alias("rebalance")).join(F.broadcast(rebalances), "rebalance")
        sums = traded.groupBy("rebalance", "symbol").agg(F.sum("volume").alias("weight"))
        place = F.row_number().over(Window.partitionBy("rebalance").orderBy(F.desc("weight"), "symbol"))
        return sums.withColumn("place", place).where(F.col("place") <= top).select("rebalance", "symbol", "weight")

    return choose


def equity_curve(allocation: DataFrame, rebalances: DataFrame, candles: DataFrame, start: float = 1000.0, keys: Sequence[str] = (), end: str | None = None) -> DataFrame:
    """(keys, timeframe, value) on every trading day from the first rebalance on, before the day in column ``end``.

    Within a period the value grows by the weighted mean of price over bought price, a missing price
    counting as 0; whole periods multiply. With nothing bought the value stays. ``end`` is a column of ``rebalances``.
    """
    calendar = candles.select("timeframe").distinct()
    order = Window.partitionBy(*keys).orderBy("rebalance")
    periods = rebalances.withColumn("until", F.coalesce(F.lead("rebalance").over(order), F.col(end) if end else F.lit(None)))  # a calendar
    days = calendar.join(F.broadcast(periods), (F.col("timeframe") >= F.col("rebalance")) & (F.col("until").isNull() | (F.col("timeframe") <= F.col("until"))))
    held = days.join(allocation, [*keys, "rebalance"], "left")
    prices = candles.select("symbol", "timeframe", median_price(F.col("high"), F.col("low")).alias("now"))
    held = held.join(prices, ["symbol", "timeframe"], "left")
    part = F.when(F.col("symbol").isNull(), F.lit(None)).otherwise(F.col("weight") * ieee_div(F.coalesce("now", F.lit(0.0)), F.col("price")))
    growth = held.groupBy(*keys, "rebalance", "until", "timeframe").agg(F.coalesce(F.sum(part), F.lit(1.0)).alias("growth"))
    whole = growth.where("timeframe = until").select(*keys, "rebalance", F.col("growth").alias("whole"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    bases = rebalances.join(whole, [*keys, "rebalance"], "left").withColumn("base", F.coalesce(F.product(F.coalesce("whole", F.lit(1.0))).over(before), F.lit(1.0)))
    curve = growth.where("until is null or timeframe < until").join(F.broadcast(bases.select(*keys, "rebalance", "base")), [*keys, "rebalance"])
    return curve.select(*keys, "timeframe", (F.lit(start) * F.col("base") * F.col("growth")).alias("value"))


def performance(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, volatility, sharpe, max_drawdown, days_under_water) of each curve; null where a curve is flat or of one day."""
    w = Window.partitionBy(*keys).orderBy("timeframe")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = curve.withColumn("r", ieee_div(F.col("value"), F.lag("value").over(w)) - 1).withColumn("peak", F.max("value").over(run))
    rows = rows.withColumn("peak_day", F.last(F.when(F.col("value") == F.col("peak"), F.col("timeframe")), ignorenulls=True).over(run))
    scale = float(TRADING_DAYS) ** 0.5
    out = rows.groupBy(*keys).agg(F.avg("r").alias("__m"), F.stddev_samp("r").alias("__s"), F.min(F.col("value") / F.col("peak") - 1).alias("max_drawdown"), F.max(F.datediff("timeframe", "peak_day")).alias("days_under_water"))
    flat = F.col("__s") != 0
    return out.select(*keys, F.when(flat, F.col("__s") * scale).alias("volatility"), F.when(flat, F.col("__m") / F.col("__s") * scale).alias("sharpe"), "max_drawdown", "days_under_water")


def adaptive_choice(candles: DataFrame, optimisations: DataFrame, months: Sequence[int], weeks: Sequence[int], tops: Sequence[int], frequencies: Sequence[str] = ("monthly",)) -> DataFrame:
    """(rebalance, months, weeks, top, frequency, sharpe): at each day, the combination that would have done best over the year before.

    Each combination's curve runs over the trailing year. Combinations are keys of one plan: symbols are chosen
    once for each day and lookback, whatever the numbers and years that use them. Of equal Sharpe ratios (to nine
    digits) the first combination wins; without any, the first of each list.
    """
    days = optimisations.select(F.col("rebalance").alias("optimise"))
    trading = candles.select("timeframe").distinct()
    firsts = reduce(DataFrame.union, [trading.groupBy(period_key(F.col("timeframe"), f).alias("p")).agg(F.min("timeframe").alias("rebalance")).select(F.lit(f).alias("frequency"), "rebalance") for f in frequencies])
    looks = F.explode(F.array(*[F.struct(F.lit(m).alias("months"), F.lit(k).alias("weeks")) for m in months for k in weeks]))
    places = F.explode(F.array(*[F.lit(n) for n in tops]))
    in_year = (F.col("rebalance") >= F.add_months("optimise", -12)) & (F.col("rebalance") < F.col("optimise"))
    spans = firsts.join(F.broadcast(days), in_year)  # calendars both
    looked = spans.select("rebalance").distinct().select("rebalance", looks.alias("look")).select("rebalance", "look.*")
    choice = momentum_choice(candles, looked, F.col("months"), F.col("weeks"), max(tops), ["months", "weeks"])
    own = ["months", "weeks", "top"]
    bought = allocate(choice.withColumn("top", places).where("place <= top"), candles, own)
    keys = ["optimise", *own, "frequency"]
    runs = spans.select("*", looks.alias("look")).select("optimise", "frequency", "rebalance", "look.*", places.alias("top"))
    curve = equity_curve(bought.join(F.broadcast(runs), [*own, "rebalance"]), runs, candles, keys=keys, end="optimise")
    tried = performance(curve, keys).where("sharpe is not null and not isnan(sharpe)")
    lists = (("months", months), ("weeks", weeks), ("top", tops), ("frequency", frequencies))
    nth = [F.array_position(F.array(*[F.lit(x) for x in v]), F.col(c)) for c, v in lists]
    w = Window.partitionBy("optimise").orderBy(F.desc(quantised(F.col("sharpe"), 9)), *nth)
    best = tried.withColumn("n", F.row_number().over(w)).where("n = 1")
    first = [F.coalesce(c, F.lit(v[0])).alias(c) for c, v in lists]
    return days.join(best, "optimise", "left").select(F.col("optimise").alias("rebalance"), *first, "sharpe")
