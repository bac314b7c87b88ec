"""Panel operators: windows, imputation, standardising, embeddings, alignment, factor loadings.

A panel stays long: one row per window, symbol and day. Sums over symbols are taken in Spark; only
matrices of a window's days or of an embedding's dimensions, whatever the number of symbols, reach numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import cosine, dot, is_finite
from ..sources.writers import written

DIMENSIONS = 16
MIN_MISSING = 0.1


def span(df: DataFrame, day: str) -> tuple[date, date] | None:
    """The first and last day of a table, null for an empty one."""
    first, last = df.agg(F.min(day), F.max(day)).first()
    return (first, last) if first else None


def window_ends(first: date, last: date, step_months: int) -> Column:
    return F.sequence(F.lit(first), F.lit(last), F.expr(f"interval {step_months} months"))


def all_window_ends(df: DataFrame, day: str, step_months: int, months: int) -> Column:
    """Ends of whole windows over all days of ``df``: the first is ``months`` after the start of its first month, the last the day after its last day at most."""
    days = span(df, day)
    if days is None:
        return F.array().cast("array<date>")
    first, end = F.add_months(F.trunc(F.lit(days[0]), "month"), months), F.date_add(F.lit(days[1]), 1)
    return F.when(first <= end, F.sequence(first, end, F.expr(f"interval {step_months} months"))).otherwise(F.array().cast("array<date>"))


def assign_windows(df: DataFrame, day: str, ends: Column, months: int, left_open: bool = False) -> DataFrame:
    """A row for each window that holds it, with ``window_end``: [end - months, end), or (end - months, end]."""
    inside = (lambda e: (F.col(day) > F.add_months(e, -months)) & (F.col(day) <= e)) if left_open else (lambda e: (F.col(day) >= F.add_months(e, -months)) & (F.col(day) < e))
    return df.withColumn("window_end", F.explode(F.filter(ends, inside)))


def assign_stepped(df: DataFrame, day: str, step_days: int, months: int) -> DataFrame:
    """A row for each window (end - months, end] that holds it, with ``window_end``; ends step by ``step_days`` over all of the table.

    The first window ends a month's length after the first day, the last one on the last day or less than a
    step after it. The few ends that a day may belong to are counted from the day itself, so many windows cost nothing.
    """
    days = span(df, day)
    if days is None:
        return df.withColumn("window_end", F.lit(None).cast("date"))
    start = F.date_sub(F.add_months(F.lit(days[0]), months), 1)
    top = F.floor((F.datediff(F.lit(days[1]), start) + step_days - 1) / step_days)  # number of the last end
    low = F.greatest(F.lit(0).cast("long"), F.ceil(F.datediff(F.col(day), start) / step_days))
    high = F.least(top, F.floor((F.datediff(F.col(day), start) + 31 * months) / step_days))
    numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    ends = F.transform(numbers, lambda k: F.date_add(start, (k * step_days).cast("int")))
    return df.withColumn("window_end", F.explode(F.filter(ends, lambda e: (F.col(day) > F.add_months(e, -months)) & (F.col(day) <= e))))


def complete_panel(rows: DataFrame, day: str, value: str, max_missing: float = MIN_MISSING) -> DataFrame:
    """(window_end, symbol, day, value): symbols with few missing days, every gap filled by that day's mean over all symbols.

    ``rows(window_end, symbol, day, value)``; null and infinite values are missing. Days without any value are left out.
    """
    one = written(rows.groupBy("window_end", "symbol", day).agg(F.max(F.when(is_finite(F.col(value)), F.col(value))).alias(value)), "windowed")  # read four times
    days = one.groupBy("window_end").agg(F.count_distinct(day).alias("n_days"))
    means = one.groupBy("window_end", day).agg(F.avg(value).alias("day_mean")).where("day_mean is not null")
    kept = one.groupBy("window_end", "symbol").agg(F.count(value).alias("valid")).join(F.broadcast(days), "window_end").where(1 - F.col("valid") / F.col("n_days") <= max_missing).select("window_end", "symbol")
    grid = kept.join(F.broadcast(means), "window_end")  # a window's calendar on each of its symbols
    return grid.join(one, ["window_end", "symbol", day], "left").select("window_end", "symbol", day, F.coalesce(value, "day_mean").alias(value))


def standardised(panel: DataFrame, value: str) -> DataFrame:
    """With ``z``: each symbol's values in a window less their mean, by their deviation."""
    w = Window.partitionBy("window_end", "symbol")
    return panel.withColumn("z", (F.col(value) - F.avg(value).over(w)) / (F.stddev_pop(value).over(w) + 1e-8))


def _matrix_sums(key: str, left: str, right: str):
    """(key, sum) with the sum of outer products of two array columns over a task's rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for f in frames:
            for k, part in f.groupby(key):
                own = np.stack(part[left].to_list()).T @ np.stack(part[right].to_list())
                total[k] = total[k] + own if k in total else own
        if total:
            yield pd.DataFrame({key: list(total), "sum": [m.reshape(-1).tolist() for m in total.values()]})

    return run


def _summed(df: DataFrame, key: str, left: str, right: str) -> dict:
    """{key: matrix}; one small matrix a key and task is shuffled, one a key reaches the driver."""
    parts = df.select(key, F.col(left).alias("left"), F.col(right).alias("right")).mapInPandas(_matrix_sums(key, "left", "right"), f"{key} date, sum array<double>")
    cells = parts.select(key, F.posexplode("sum").alias("i", "x")).groupBy(key, "i").agg(F.sum("x").alias("x"))
    whole = cells.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda c: c["x"]).alias("m"))
    return {r[key]: np.array(r["m"]) for r in whole.toLocalIterator()}


def embeddings(panel: DataFrame, day: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(window_end, symbol, embedding): each window's standardised panel times its leading right singular vectors.

    The sign of each vector is that which makes its largest entry positive. There are at most as many
    dimensions as any window has days, and at most half as many as it has symbols.
    """
    spark = panel.sparkSession
    rows = panel.groupBy("window_end", "symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct(day, "z"))), lambda c: c["z"]).alias("r"))  # a window's days
    rows = written(rows, "panel_rows")
    bases, grams = [], _summed(rows, "window_end", "r", "r")
    symbols = {r[0]: r[1] for r in rows.groupBy("window_end").count().collect()}  # a row a window
    dimensions = min([dimensions, *(int(round(len(g) ** 0.5)) for g in grams.values()), *(max(1, n // 2) for n in symbols.values())])
    for end, gram in sorted(grams.items()):
        n = int(round(len(gram) ** 0.5))
        _, vectors = np.linalg.eigh(gram.reshape(n, n))
        v = vectors[:, ::-1][:, :dimensions]
        v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
        bases.append((end, v.T.tolist()))
    basis = spark.createDataFrame(bases, "window_end date, v array<array<double>>")
    return rows.join(F.broadcast(basis), "window_end").select("window_end", "symbol", F.transform("v", lambda v: dot(v, F.col("r"))).alias("embedding"))


def procrustes(cross: np.ndarray) -> np.ndarray:
    """The rotation R that brings A nearest to B, from A'B."""
    u, _, v = np.linalg.svd(cross)
    return u @ v


def align_windows(vectors: DataFrame) -> DataFrame:
    """With ``aligned``: all windows turned to the newest one, each by the rotation to the next one on the symbols they share.

    Raises where two neighbouring windows share fewer symbols than there are dimensions.
    """
    spark, vectors = vectors.sparkSession, written(vectors, "vectors")
    ends = [r[0] for r in vectors.select("window_end").distinct().orderBy("window_end").collect()]  # one row a window
    if not ends:
        return vectors.withColumn("aligned", F.col("embedding"))
    k = int(vectors.select(F.size("embedding")).first()[0])
    after = spark.createDataFrame(list(zip(ends, ends[1:])), "window_end date, next_end date")
    nxt = vectors.select(F.col("window_end").alias("next_end"), "symbol", F.col("embedding").alias("b"))
    both = vectors.join(F.broadcast(after), "window_end").join(nxt, ["next_end", "symbol"])
    shared = {r[0]: r[1] for r in both.groupBy("window_end").count().collect()}
    short = [e for e in ends[:-1] if shared.get(e, 0) < k]
    if short:
        raise ValueError(f"windows share fewer than {k} symbols with the next: {short}")
    cross = _summed(both, "window_end", "embedding", "b") if len(ends) > 1 else {}
    turn, rotations = np.eye(k), []
    for e in reversed(ends):
        if e in cross:
            turn = procrustes(cross[e].reshape(k, k)) @ turn
        rotations.append((e, turn.T.tolist()))
    table = spark.createDataFrame(rotations, "window_end date, turn array<array<double>>")
    return vectors.join(F.broadcast(table), "window_end").select(*vectors.columns, F.transform("turn", lambda c: dot(c, F.col("embedding"))).alias("aligned"))


def alignment_report(aligned: DataFrame, first: date, second: date) -> DataFrame:
    """One row: gap, self-cosine before and after between two windows, and the same for symbols of high and low norm."""
    a = aligned.where(F.col("window_end") == F.lit(first)).select("symbol", F.col("embedding").alias("a0"), F.col("aligned").alias("a1"))
    b = aligned.where(F.col("window_end") == F.lit(second)).select("symbol", F.col("embedding").alias("b0"), F.col("aligned").alias("b1"))
    both = a.join(b, "symbol").withColumn("na", F.sqrt(dot(F.col("a0"), F.col("a0")))).withColumn("nb", F.sqrt(dot(F.col("b0"), F.col("b0"))))
    cuts = both.agg(*[F.percentile(n, q).alias(f"{n}_{name}") for n in ("na", "nb") for q, name in ((0.5, "mid"), (0.25, "low"))])
    both = both.join(F.broadcast(cuts)).withColumn("before", cosine(F.col("a0"), F.col("b0"))).withColumn("after", cosine(F.col("a1"), F.col("b1")))
    gap = F.zip_with("a1", "b1", lambda x, y: x - y)
    high = (F.col("na") > F.col("na_mid")) & (F.col("nb") > F.col("nb_mid"))
    low = (F.col("na") < F.col("na_low")) & (F.col("nb") < F.col("nb_low"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.sum(dot(gap, gap))).alias("gap"), F.avg("before").alias("cosine_before"), F.avg("after").alias("cosine_after"), F.avg(F.when(high, F.col("after"))).alias("cosine_high"), F.avg(F.when(low, F.col("after"))).alias("cosine_low"))


FACTORS = ("mkt_rf", "smb", "hml")


def excess_returns(returns: DataFrame, factors: DataFrame, scale: float = 1.0) -> DataFrame:
    """Returns with the day's factors, scaled, and ``excess`` over the riskless rate."""
    scaled = factors.select("timeframe", *[(F.col(c) * scale).alias(c) for c in (*FACTORS, "rf")])
    return returns.join(F.broadcast(scaled), "timeframe").withColumn("excess", F.col("log_return_1d") - F.col("rf"))


def factor_loadings(rows: DataFrame, keys: tuple[str, ...] = ("window_end", "symbol")) -> DataFrame:
    """(keys, alpha, beta_mkt_rf, beta_smb, beta_hml, n): least squares of ``excess`` on the factors.

    A group shuffles its 14 moment sums only; a singular design gives the least solution.
    """
    x = [F.lit(1.0), *[F.col(c) for c in FACTORS]]
    used = rows.where(" and ".join(f"{c} is not null" for c in (*FACTORS, "excess")))
    sums = [F.sum(x[i] * x[j]).alias(f"m{i}{j}") for i in range(4) for j in range(i, 4)] + [F.sum(x[i] * F.col("excess")).alias(f"y{i}") for i in range(4)]
    moments = used.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)

    @F.pandas_udf("array<double>")
    def solved(m: pd.Series, y: pd.Series) -> pd.Series:
        upper = np.triu_indices(4)
        out = []
        for a, b in zip(m, y):
            g = np.zeros((4, 4))
            g[upper] = a
            g = g + np.triu(g, 1).T
            out.append((np.linalg.pinv(g, hermitian=True) @ np.asarray(b)).tolist())
        return pd.Series(out)

    fit = solved(F.array(*[f"m{i}{j}" for i in range(4) for j in range(i, 4)]), F.array(*[f"y{i}" for i in range(4)]))
    return moments.withColumn("b", fit).select(*keys, F.col("b")[0].alias("alpha"), *[F.col("b")[i + 1].alias(f"beta_{c}") for i, c in enumerate(FACTORS)], "n")


def _whole_windows(first: date | None, last: date | None, months: int, step_months: int) -> int:
    """How many windows ``all_window_ends`` has."""
    if first is None or last is None:
        return 0
    after = last + timedelta(days=1)
    passed = (after.year - first.year) * 12 + after.month - first.month
    return max(0, (passed - months) // step_months + 1)


def rolling_loadings(rows: DataFrame, factors: DataFrame, day: str, first: date | None, last: date | None, months: int = 36, step_months: int = 3, max_missing: float = MIN_MISSING) -> DataFrame:
    """(window_end, symbol, alpha, betas, n): loadings of every window as by ``complete_panel`` and ``factor_loadings``,
    from sums over blocks of ``step_months`` that are taken once and added up, not from a copy of the rows for each window.

    ``rows(symbol, day, excess)`` and ``factors`` by day; the windows are those of ``all_window_ends`` over the days from
    ``first`` to ``last``. A missing day of a symbol is filled by the day's mean over all symbols, so the design is the
    same for all symbols of a window, and a symbol's own sums need only its distances from the means, where it has values:
    a filled day adds nothing. Null and infinite values are missing; of several on a day the greatest counts.
    Days, blocks and windows are few, whatever the number of symbols; a symbol moves one row of five sums a block.
    """
    if months % step_months:
        raise ValueError(f"{step_months} months don't divide a window of {months}")
    width, windows = months // step_months, _whole_windows(first, last, months, step_months)
    begin = (first or date(1970, 1, 1)).replace(day=1)
    month = (F.year(day) - begin.year) * 12 + F.month(day) - begin.month
    one = rows.groupBy("symbol", day).agg(F.max(F.when(is_finite(F.col("excess")), F.col("excess"))).alias("v"))
    x = [F.lit(1.0), *[F.col(c) for c in FACTORS]]
    met = factors.select(day, *FACTORS).where(" and ".join(f"{c} is not null" for c in FACTORS))
    days = one.groupBy(day).agg(F.avg("v").alias("mean")).join(met, day, "left").withColumn("used", F.col("mean").isNotNull() & F.col(FACTORS[0]).isNotNull())
    days = days.withColumn("block", F.floor(month / step_months).cast("long"))

    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    when_used = lambda c: F.sum(F.when(F.col("used"), c))
    sums = [when_used(x[i] * x[j]).alias(f"m{i}{j}") for i, j in pairs] + [when_used(x[i] * F.col("mean")).alias(f"y{i}") for i in range(4)]
    by_block = days.groupBy("block").agg(F.count(F.lit(1)).alias("n_days"), F.count_if("used").alias("n"), *sums)
    ends = by_block.withColumn("end", F.explode(F.sequence("block", F.col("block") + width - 1)))
    design = ends.groupBy("end").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in by_block.columns[1:]]).where(F.col("end").between(width - 1, width - 2 + windows))

    @F.pandas_udf("array<double>")
    def inverse(m: pd.Series) -> pd.Series:
        upper, out = np.triu_indices(4), []
        for a in m:
            g = np.zeros((4, 4))
            g[upper] = a
            out.append(np.linalg.pinv(g + np.triu(g, 1).T, hermitian=True).reshape(-1).tolist())
        return pd.Series(out)

    design = design.select("end", "n_days", "n", *[f"y{i}" for i in range(4)], inverse(F.array(*[f"m{i}{j}" for i, j in pairs])).alias("p"))  # a row a window

    apart = F.col("v") - F.col("mean")
    own = one.join(F.broadcast(days), day).groupBy("symbol", "block").agg(F.count("v").alias("valid"), *[F.coalesce(when_used(x[i] * apart), F.lit(0.0)).alias(f"d{i}") for i in range(4)])
    by_symbol = Window.partitionBy("symbol").orderBy("block")
    until = F.least(F.coalesce(F.lead("block").over(by_symbol) - 1, F.col("block") + width - 1), F.col("block") + width - 1)
    here = own.withColumn("until", until).withColumn("end", F.explode(F.sequence("block", "until")))  # windows may end in blocks that a symbol lacks
    held = lambda c, zero: F.when(F.col("end") == F.col("block"), F.col(c)).otherwise(zero)
    last_blocks = Window.partitionBy("symbol").orderBy("end").rangeBetween(-(width - 1), 0)
    rolled = here.select("symbol", "end", F.sum(held("valid", 0)).over(last_blocks).alias("valid"), *[F.sum(held(f"d{i}", 0.0)).over(last_blocks).alias(f"d{i}") for i in range(4)])
    both = rolled.join(F.broadcast(design), "end").where((F.col("n") > 0) & (1 - F.col("valid") / F.col("n_days") <= max_missing))
    fit = [reduce(lambda a, b: a + b, [F.col("p")[4 * i + k] * (F.col(f"y{k}") + F.col(f"d{k}")) for k in range(4)]) for i in range(4)]
    window_end = F.add_months(F.lit(begin), ((F.col("end") + 1) * step_months).cast("int"))
    return both.select(window_end.alias("window_end"), "symbol", fit[0].alias("alpha"), *[fit[i + 1].alias(f"beta_{c}") for i, c in enumerate(FACTORS)], "n")


def adjacent_cosine(vectors: DataFrame, column: str = "embedding", key: str = "symbol", period: str = "window_end") -> DataFrame:
    """(key, period, before, cosine) of each vector with the one of the period just before it; a key that skips a period has no pair."""
    periods = vectors.select(period).distinct()
    ordered = periods.select(period, F.lag(period).over(Window.orderBy(period)).alias("before"))  # one row a period
    earlier = vectors.select(F.col(key), F.col(period).alias("before"), F.col(column).alias("__b"))
    return vectors.join(F.broadcast(ordered), period).join(earlier, [key, "before"]).select(key, period, "before", cosine(F.col(column), F.col("__b")).alias("cosine"))

