"""Composed tables: candles with indicators, padded facts, valuations, rankings, universes, training rows."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as E
from ..operators.asof import asof_backward, pad_daily
from ..operators.blocks import BLOCKS, numbers, pack, record, rows_of, unpack
from ..operators.ordered import HOT_ROWS, trailing_windows
from ..operators.portfolio import _symbols
from ..sources.writers import brief_shuffles, written

# fixed values: rows that each named lookback goes back, and the largest ranks of the two universes
LOOKBACKS = (1, 5, 14, 20, 30, 62, 126, 252)
NAMED = {"1d": 1, "1w": 5, "1m": 20, "30_steps": 30, "1q": 62, "6m": 126, "1y": 252}
GOOD_RANK, APPROXIMATE_RANK = 2500, 600
OVERBOUGHT, OVERSOLD = 70, 30
ODD_NAMES = {"open_rolling_1d": "open_rolling_1_steps_1d", "volatility_1d": "volatility_1_steps_1d", "sharpe_1d": "sharpe_1_steps_1d"}
KINDS = ("log_return", "return", "open_rolling", "volatility", "sharpe", "rsi")
INDICATORS = {ODD_NAMES.get(f"{kind}_{name}", f"{kind}_{name}"): (kind, n) for name, n in NAMED.items() for kind in KINDS} | {"rsi": ("rsi", 14)}
PRICES = ("open", "close", "high", "low", "volume")


def candles_daily(candles: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Candles with returns, rolling opens, volatilities, Sharpe ratios and relative strengths of all lookbacks.

    One exchange and one sort by symbol serve every window; a symbol with more than ``hot_rows`` rows is cut into
    blocks of days. A group's lookbacks are taken over numpy views, as window functions would go through all rows of a
    frame for each row, and differences of running sums lose digits. Prices of any size, NaN and infinities count as they
    are, in the windows that hold them; a null open is left out of rolling means.
    """
    base = candles.select("symbol", "timeframe", F.year("timeframe").alias("year"), F.month("timeframe").alias("month"), "open", "close", "high", "low", "volume")
    return trailing_windows(base, ["symbol"], ["timeframe"], max(LOOKBACKS), _indicators, hot_rows)


def _trailing(x: np.ndarray, n: int) -> np.ndarray:
    """A row for each entry with the n entries up to it, NaN before the first; a view."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(n - 1, np.nan), x]), n)


def _count(there: np.ndarray, n: int) -> np.ndarray:
    """How many of the last n entries are there."""
    total = np.concatenate([np.zeros(n, int), np.cumsum(there)])
    return total[n:] - total[: len(there)]


def _rolled_each(x: np.ndarray, there: np.ndarray, n: int, spread: bool = False) -> np.ndarray:
    """``_rolled`` with each window summed on its own, in slices; for entries that are not finite, and for means of
    prices, which often lie halfway between two figures, so that the order of a sum shows in rounded results."""
    out = np.full(len(x), np.nan)
    step = max(1, (1 << 18) // n)
    values, held = _trailing(np.where(there, x, 0.0), n), _trailing(there.astype(float), n)
    for i in range(0, len(x), step):
        v, h = values[i : i + step], held[i : i + step] == 1
        k = h.sum(axis=1)
        mean = np.where(h, v, 0.0).sum(axis=1) / np.maximum(k, 1)
        if spread:
            first = np.where(h, v, -np.inf).max(axis=1)
            even = (np.where(h, v, np.inf).min(axis=1) == first)[:, None]
            square = np.where(h & ~even, v - mean[:, None], 0.0) ** 2
            out[i : i + step] = np.where(k > 1, np.sqrt(square.sum(axis=1) / np.maximum(k - 1, 1)), np.nan)
        else:
            out[i : i + step] = np.where(k > 0, mean, np.nan)
    return out


def _ahead(parts: np.ndarray) -> np.ndarray:
    """What ``parts[block, place]``, sums from each place to its block's end, give to windows that end one block on."""
    out = np.zeros_like(parts)
    out[1:, :-1] = parts[:-1, 1:]
    return out


def _rolled(x: np.ndarray, there: np.ndarray, n: int, spread: bool = False) -> np.ndarray:
    """Mean, or sample deviation, of the last n entries that are there; NaN without enough.

    In blocks of n entries a window is the end of one block and the beginning of the next, so two running sums in each
    block serve all windows. Nothing is subtracted, and deviations are taken from an entry of the window itself, so no value matters outside
    its windows and equal values have a deviation of exactly 0.
    """
    x = np.where(there, x, 0.0)
    if not np.isfinite(x).all():
        return _rolled_each(x, there, n, spread)
    rows, blocks = len(x), -(-len(x) // n)
    v, h = np.zeros(blocks * n), np.zeros(blocks * n, bool)
    v[:rows], h[:rows] = x, there
    v, h = v.reshape(blocks, n), h.reshape(blocks, n)
    heads, tails = (lambda a: a.cumsum(axis=1)), (lambda a: _ahead(a[:, ::-1].cumsum(axis=1)[:, ::-1]))
    k1, k2 = heads(h), tails(h)
    k = k1 + k2
    if not spread:
        out = np.where(k > 0, (heads(v) + tails(v)) / np.maximum(k, 1), np.nan)
        return out.ravel()[:rows]
    every, (n1, n2) = np.arange(blocks), (np.maximum(k1, 1), np.maximum(k2, 1))
    first, last = v[every, h.argmax(axis=1)][:, None], v[every, n - 1 - h[:, ::-1].argmax(axis=1)][:, None]
    d1, d2 = np.where(h, v - first, 0.0), np.where(h, v - last, 0.0)
    s1, s2 = heads(d1), tails(d2)
    q1, q2 = heads(d1 * d1) - s1 * s1 / n1, tails(d2 * d2) - s2 * s2 / n2
    before = np.concatenate([first[:1], last[:-1]])  # the entry that the block before is measured from
    apart = np.where((k1 > 0) & (k2 > 0), (first - before) + (s1 / n1 - s2 / n2), 0.0)
    square = np.maximum(q1, 0) + np.maximum(q2, 0) + apart * apart * (k1 * k2 / np.maximum(k, 1))
    return np.where(k > 1, np.sqrt(square / np.maximum(k - 1, 1)), np.nan).ravel()[:rows]


def _measures(opens: np.ndarray, known: np.ndarray, close: np.ndarray, has_close: np.ndarray, wanted: Collection[str] | None = None) -> dict[str, np.ndarray]:
    """Lagged returns and rolling measures of one group in order, all or the ``wanted`` ones; nulls are masked by ``no_`` entries of the same names."""
    out: dict[str, np.ndarray] = {}
    lagged = {}
    asked = lambda kind, n: wanted is None or f"{kind}{n}" in wanted
    for n in LOOKBACKS:
        if n > 1 and not asked("log", n) and not asked("ret", n):
            continue
        base, both = np.full(len(close), np.nan), np.zeros(len(close), bool)
        base[n:], both[n:] = close[:-n], has_close[n:] & has_close[:-n]
        positive = both & ~(close <= 0) & ~(base <= 0)  # NaN stands above all numbers
        lagged[n] = np.log(close / base), positive
        out[f"log{n}"], out[f"no_log{n}"] = lagged[n][0], ~positive
        out[f"ret{n}"], out[f"no_ret{n}"] = (close - base) / base, ~both | (base == 0)
        if n == 1:
            move = np.where(both, close - base, 0.0)
    gain, loss, all_rows = np.where(move <= 0, 0.0, move), np.where(move < 0, -move, 0.0), np.ones(len(close), bool)
    for n in LOOKBACKS:
        if asked("open", n):
            out[f"open{n}"], out[f"no_open{n}"] = _rolled_each(opens, known, n), _count(known, n) < 1
        if asked("vol", n):
            out[f"vol{n}"], out[f"no_vol{n}"] = _rolled(*lagged[1], n, True), _count(lagged[1][1], n) < 2
        if asked("rsi", n):
            out[f"rsi{n}"] = 100 - 100 / (1 + _rolled(gain, all_rows, n) / _rolled(loss, all_rows, n))
    return out


def _indicators(base: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    found = [f"{k}{n}" for n in LOOKBACKS for k in ("log", "ret", "open", "vol", "rsi")]
    schema = T.StructType(base.schema.fields + [T.StructField(f"__{c}", T.DoubleType()) for c in found])

    def run(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [(c, "ascending") for c in order]))
        prices = [group[c].cast(pa.float64()).combine_chunks() for c in ("open", "close")]
        opens, close = ((c.to_numpy(zero_copy_only=False), c.is_valid().to_numpy(zero_copy_only=False)) for c in prices)
        with np.errstate(all="ignore"):
            own = _measures(*opens, *close)
        return pa.Table.from_arrays([*group.columns, *[pa.array(own[c], mask=own.get(f"no_{c}")) for c in found]], schema.names)

    df = base.groupBy(*keys).applyInArrow(run, schema)
    value = lambda c: F.col(f"__{c}")
    out = [F.col(c) for c in base.columns if not c.startswith("__")]
    for name, n in NAMED.items():
        own = {
            f"log_return_{name}": value(f"log{n}"),
            f"return_{name}": value(f"ret{n}"),
            f"open_rolling_{name}": value(f"open{n}"),
            f"volatility_{name}": value(f"vol{n}"),
            f"sharpe_{name}": E.sharpe_ratio(value(f"ret{n}"), value(f"vol{n}")),
            f"rsi_{name}": value(f"rsi{n}"),
        }
        out += [c.alias(ODD_NAMES.get(k, k)) for k, c in own.items()]
    rsi = value("rsi14")
    extra = [c for c in base.columns if c.startswith("__")]  # the blocks of hot symbols
    return df.select(*out, rsi.alias("rsi"), (rsi > OVERBOUGHT).alias("overbought"), (rsi < OVERSOLD).alias("oversold"), *extra)


def candle_blocks(candles: DataFrame, rows: int = 1 << 16) -> DataFrame:
    """Candles in blocks of whole symbols, written once; ``candle_columns`` makes indicators of a block, so none is stored or moved.

    ``candles`` must be dealt by symbol. A symbol has one candle a day at most, so a block grows with days only. ``data`` has where
    symbols begin, which prices are there, days and prices; prices are told from opens, which most candles of one trade equal.
    """
    schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("data", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (_, number, own) in zip(numbers(), _symbols(batches, rows, rows)):
            prices = [own[c].cast(pa.float64()).combine_chunks() for c in PRICES]
            there = sum(p.is_valid().to_numpy(zero_copy_only=False).astype(np.int64) << i for i, p in enumerate(prices))
            bits = [p.fill_null(0.0).to_numpy(zero_copy_only=False).view(np.int64) for p in prices]
            day = own["timeframe"].cast(pa.int32()).cast(pa.int64()).combine_chunks().fill_null(NO_DAY).to_numpy(zero_copy_only=False)
            columns = [np.flatnonzero(np.diff(number, prepend=-1)), there, day, bits[0], *[b ^ bits[0] for b in bits[1:4]], bits[4]]
            yield record([(block, own.num_rows, [len(columns[0]).to_bytes(8, "little"), *[pack(c) for c in columns]])], schema)

    with brief_shuffles(candles.sparkSession):
        return written(candles.select("symbol", "timeframe", *PRICES).sortWithinPartitions("symbol", "timeframe").mapInArrow(run, BLOCKS), "candles")


NO_DAY = np.iinfo(np.int64).min


def candle_columns(row: Mapping, names: Collection[str], steps: int = 5) -> tuple[np.ndarray, np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Where the symbols of a block begin, its days, and (values, which are there) of prices, ``future_price`` (the open ``steps`` rows on) and INDICATORS."""
    n, data = row["n"], row["data"]
    starts = unpack(data[1], int.from_bytes(data[0], "little"), np.int64)
    there, day, *bits = (unpack(x, n, np.int64) for x in data[2:])
    bits = [bits[0], *[b ^ bits[0] for b in bits[1:4]], bits[4]]
    out = {c: (b.view(np.float64), there >> i & 1 == 1) for i, (c, b) in enumerate(zip(PRICES, bits))}
    ends = np.append(starts[1:], n)
    if "future_price" in names:
        later = np.arange(n) + steps
        inside = later < np.repeat(ends, ends - starts)
        later = np.where(inside, later, 0)
        out["future_price"] = out["open"][0][later], out["open"][1][later] & inside
    asked = {c: INDICATORS[c] for c in names if c in INDICATORS}
    if asked:
        short = {"log_return": ("log",), "return": ("ret",), "open_rolling": ("open",), "volatility": ("vol",), "sharpe": ("ret", "vol"), "rsi": ("rsi",)}
        wanted = {f"{k}{m}" for kind, m in asked.values() for k in short[kind]}
        found = {c: (np.empty(n), np.ones(n, bool)) for c in wanted}
        with np.errstate(all="ignore"):
            for a, b in zip(starts, ends):
                own = _measures(*[x[a:b] for c in ("open", "close") for x in out[c]], wanted)
                for c in wanted:
                    found[c][0][a:b] = own[c]
                    if f"no_{c}" in own:
                        found[c][1][a:b] = ~own[f"no_{c}"]
            for c, (kind, m) in asked.items():
                values, known = found[f"{short[kind][0]}{m}"]
                if kind == "sharpe":
                    over, has = found[f"vol{m}"]
                    values, known = values / over, known & has & (over != 0)
                out[c] = values, known
    return starts, day, {c: out[c] for c in names}


def causal_scores(columns: Mapping[str, tuple[np.ndarray, np.ndarray]], starts: np.ndarray) -> dict[str, np.ndarray]:
    """``labels.causal_zscore`` of a block's columns: each value against its symbol's mean and deviation up to that row, added up in the same order."""
    if not columns:
        return {}
    n = len(next(iter(columns.values()))[0])
    sizes = np.diff(starts, append=n)
    symbol, place = np.repeat(np.arange(len(starts)), sizes), np.arange(n) - np.repeat(starts, sizes)
    shape = (int(sizes.max(initial=0)), len(columns), len(starts))
    x, there = np.zeros(shape), np.zeros(shape, bool)
    for i, (values, known) in enumerate(columns.values()):
        x[place, i, symbol], there[place, i, symbol] = np.where(known, values, 0.0), known
    spread, count, mean, square = np.zeros(shape), np.zeros(shape[1:]), np.zeros(shape[1:]), np.zeros(shape[1:])
    with np.errstate(all="ignore"):
        for t in range(shape[0]):
            count = count + there[t]
            off = x[t] - mean
            step = off / count
            mean, square = np.where(there[t], mean + step, mean), np.where(there[t], square + off * (off - step), square)
            spread[t] = np.sqrt(square / (count - 1))
        counts = there.cumsum(axis=0)
        scores = np.where(there & (counts > 1) & (spread != 0), (x - x.cumsum(axis=0) / counts) / spread, 0.0)
    return {c: scores[place, i, symbol] for i, c in enumerate(columns)}


def plain_values(row: Mapping, names: Collection[str]) -> dict[str, np.ndarray]:
    """Columns of a block of candles, NaN for null."""
    return {c: np.where(there, x, np.nan) for c, (x, there) in candle_columns(row, names)[2].items()}


def scored_values(row: Mapping, names: Collection[str]) -> dict[str, np.ndarray]:
    """The same with indicators as causal z-scores."""
    starts, _, columns = candle_columns(row, names)
    scores = causal_scores({c: columns[c] for c in names if c in INDICATORS}, starts)
    return {c: scores[c] if c in scores else np.where(there, x, np.nan) for c, (x, there) in columns.items()}


def labelled_rows(blocks: DataFrame, features: Sequence[str], steps: int, threshold: float, labels: Sequence[str], days: int) -> DataFrame:
    """Rows of blocks of candles whose ``features`` are all finite, with ``future_class``, the class of the return to the open ``steps`` rows on,
    and ``is_test``: the last ``days`` days of those with a class. They are made when they are read."""

    def classes(row: Mapping, names: Collection[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
        _, day, columns = candle_columns(row, dict.fromkeys(["open", "future_price", *names]), steps)
        (price, has), (later, known) = columns["open"], columns["future_price"]
        with np.errstate(all="ignore"):
            rise = later / price - 1
        return has & known & (price != 0) & (day != NO_DAY), np.where(rise <= -threshold, 0, np.where(rise <= threshold, 1, 2)), day, columns  # NaN is above all

    def latest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            held, _, day, _ = classes(row, ())
            if held.any():
                yield pa.RecordBatch.from_arrays([pa.array([int(day[held].max())])], ["day"])

    last = blocks.mapInArrow(latest, "day long").agg(F.max("day")).first()[0] or 0
    schema = pa.schema([*[(c, pa.float64()) for c in features], ("future_class", pa.string()), ("is_test", pa.bool_())])
    names = pa.array(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            held, label, day, columns = classes(row, features)
            held = np.logical_and.reduce([held, *[columns[c][1] & np.isfinite(columns[c][0]) for c in features]])
            yield pa.RecordBatch.from_arrays([*[pa.array(columns[c][0][held]) for c in features], names.take(pa.array(label[held])), pa.array(day[held] >= last - days)], schema=schema)

    return blocks.mapInArrow(run, ", ".join([*[f"`{c}` double" for c in features], "future_class string", "is_test boolean"]))


def implied_float_shares(filings: DataFrame, candles: DataFrame) -> DataFrame:
    """``filings`` whose float, in money, is divided by the open of the period's last day; null without that day."""
    prices = candles.select(F.col("symbol").alias("cik"), F.col("timeframe").alias("period_end"), "open")
    met = filings.join(prices, ["cik", "period_end"], "left")
    value = F.when(F.col("metric") != "float", F.col("value").cast("double")).otherwise(E.ieee_div(F.col("value"), F.col("open")))
    return met.withColumn("value", value).drop("open")


METRICS = ("shares", "float", "earnings")


def fact_ranges(filings: DataFrame, as_of: Column) -> DataFrame:
    """Each company's shares, float and earnings from one filing of any of them to the day before the next, the last until as_of:
    cik, valid_from, valid_until, shares, float, earnings, last_filed.

    A filing day is a row, so this grows with filings, not with days. Of several entries of a metric on one day the last period's wins.
    """
    known = filings.where((F.col("filed") <= as_of) & F.col("metric").isin(*METRICS)).repartition("cik")  # serves both groupings
    lone = F.when(F.col("cik").isNull(), F.col("metric"))  # facts without a company don't meet
    last = lambda m: F.max(F.when(F.col("metric") == m, F.struct("period_end", "value"))).alias(m)
    days = known.groupBy("cik", lone.alias("lone"), F.col("filed").alias("valid_from")).agg(*[last(m) for m in METRICS])
    w = Window.partitionBy("cik", "lone").orderBy("valid_from")
    held = {m: F.last(m, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for m in METRICS}
    until = F.coalesce(F.date_sub(F.lead("valid_from").over(w), 1), as_of)
    return days.select("cik", "valid_from", until.alias("valid_until"), *[c["value"].alias(m) for m, c in held.items()], F.col("valid_from").alias("last_filed"))


def padded_facts(filings: DataFrame, as_of: Column) -> DataFrame:
    """Each company's shares, float and earnings on each day they were publicly known: cik, reference_date, shares, float, earnings, last_filed.

    Days are made last, so none of them is moved.
    """
    return padded_ranges(fact_ranges(filings, as_of))


def padded_ranges(ranges: DataFrame) -> DataFrame:
    return pad_daily(ranges).select("cik", "reference_date", *METRICS, "last_filed")


def valued(df: DataFrame) -> DataFrame:
    """With market_cap, price_to_earnings, float_cap and earnings_per_share (IEEE divisions)."""
    cap = F.col("shares") * F.col("open")
    return df.withColumns({
        "market_cap": cap,
        "price_to_earnings": E.ieee_div(cap, F.col("earnings")),
        "float_cap": F.col("float") * F.col("open"),
        "earnings_per_share": E.ieee_div(F.col("earnings"), F.col("shares")),
    })


def stocks_daily(candles: DataFrame, padded: DataFrame) -> DataFrame:
    """Candles with the padded facts of their day."""
    facts = padded.select(F.col("cik").alias("symbol"), F.col("reference_date").alias("timeframe"), "shares", "float", "earnings")
    return valued(candles.join(facts, ["symbol", "timeframe"], "left"))


def stocks_daily_ranges(candles: DataFrame, ranges: DataFrame, dealt: Column | None = None) -> DataFrame:
    """The same answer from ``fact_ranges``: candles meet the ranges of their month that hold their day, so no day is made or moved.

    Candles that are dealt by symbol and month already, ``dealt``, stay where they are.
    """
    month = lambda c: F.trunc(c, "month")
    months = F.explode(F.when(F.col("valid_from") <= F.col("valid_until"), F.sequence(month("valid_from"), month("valid_until"), F.expr("interval 1 month"))))
    facts = ranges.select(F.col("cik").alias("__cik"), "valid_from", "valid_until", *METRICS, months.alias("__month"))
    inside = F.col("timeframe").between(F.col("valid_from"), F.col("valid_until"))
    met = candles.join(facts.hint("merge"), (F.col("symbol") == F.col("__cik")) & ((month("timeframe") if dealt is None else dealt) == F.col("__month")) & inside, "left")
    return valued(met.drop("__cik", "__month", "valid_from", "valid_until"))


def stocks_daily_asof(candles: DataFrame, filings: DataFrame, as_of: Column) -> DataFrame:
    """The same answer without a row per calendar day: each metric joins as of its latest filing, all in one merge by symbol."""
    metrics = METRICS
    known = filings.where(F.col("filed") <= as_of)
    last = lambda m: F.max_by(F.when(F.col("metric") == m, F.struct("value")), F.when(F.col("metric") == m, F.col("period_end"))).alias(m)
    right = known.groupBy(F.col("cik").alias("symbol"), "filed").agg(*[last(m) for m in metrics])
    df = asof_backward(candles, right, ["symbol"], "timeframe", "filed", metrics, each=True)
    return valued(df.withColumns({m: F.when(F.col("timeframe") <= as_of, F.col(f"{m}.value")) for m in metrics}))


def stocks_rankings(stocks: DataFrame) -> DataFrame:
    """Rank of each symbol by market cap on each day; ties by symbol."""
    w = Window.partitionBy("timeframe").orderBy(F.desc("market_cap"), "symbol")
    return stocks.where("market_cap > 0").select("symbol", "timeframe", "market_cap", F.row_number().over(w).alias("rank"))


def good_symbols(rankings: DataFrame, below: int = GOOD_RANK) -> DataFrame:
    return rankings.where(F.col("rank") < below).select("timeframe", "symbol")


def approximate_index(rankings: DataFrame, top: int = APPROXIMATE_RANK) -> DataFrame:
    return rankings.where(F.col("rank") <= top)


def latest_snapshot(df: DataFrame, on: str = "timeframe") -> DataFrame:
    """Rows of the latest day, without the day."""
    last = df.agg(F.max(on).alias("__last"))
    return df.join(F.broadcast(last), F.col(on) == F.col("__last")).drop(on, "__last")


def append_future_returns(df: DataFrame, steps: int, thresholds: Sequence[float] | None = None, labels: Sequence[str] | None = None, price: str = "open") -> DataFrame:
    """With future_price, the price ``steps`` rows on, and, for thresholds, the class of the return to it.

    Thresholds are mirrored at 0; the tail of each symbol has nulls.
    """
    w = Window.partitionBy("symbol").orderBy("timeframe")
    df = df.withColumn("future_price", F.lead(price, steps).over(w))
    if not thresholds:
        return df
    edges = sorted({e for t in thresholds for e in (t, -t)} | ({0.0} if 0 in thresholds else set()))
    return df.withColumn("future_class", E.cut(F.col("future_price") / F.col(price) - 1, edges, labels))


def training_rows(stocks: DataFrame, universe: DataFrame, vectors: DataFrame, features: Sequence[str], labelings: Sequence[Callable[[DataFrame], DataFrame]] = ()) -> DataFrame:
    """Rows of the universe with the latest vector at or before their day; rows without a vector go, then labelings apply.

    ``vectors(symbol, not_before, embedding)``.
    """
    rows = stocks.select("symbol", "timeframe", *features).join(universe, ["timeframe", "symbol"])
    rows = asof_backward(rows, vectors, ["symbol"], "timeframe", "not_before", ["embedding"]).where("embedding is not null")
    for label in labelings:
        rows = rows.transform(label)
    return rows


def expand_array(df: DataFrame, column: str, size: int) -> DataFrame:
    """The array's entries as columns ``{column}_0`` and on."""
    return df.select("*", *[F.col(column)[i].alias(f"{column}_{i}") for i in range(size)]).drop(column)
