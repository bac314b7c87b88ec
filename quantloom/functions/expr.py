"""Column functions. Spark's ANSI division raises on zero, so IEEE division is spelled out here."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def ieee_div(n: Column, d: Column) -> Column:
    """n / d with 0/0 = NaN and x/0 = +-infinity; null if either is null."""
    n, d = n.cast("double"), d.cast("double")
    at_zero = F.when((n == 0) | F.isnan(n), F.lit(float("nan"))).when(n > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(n.isNull() | d.isNull(), F.lit(None).cast("double")).when(d != 0, n / d).otherwise(at_zero)


def is_finite(x: Column) -> Column:
    """Neither NaN nor infinite; null for null."""
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def quantised(x: Column, digits: int = 6) -> Column:
    """x on a grid of 10**-digits by floor, the same arithmetic in every engine."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def log_return(current: Column, base: Column) -> Column:
    """ln(current / base), null unless both are positive."""
    return F.when((current > 0) & (base > 0), F.ln(current / base))


def arithmetic_return(current: Column, base: Column) -> Column:
    """(current - base) / base, null where base is 0."""
    return F.when(base != 0, (current - base) / base)


def sharpe_ratio(ret: Column, vol: Column) -> Column:
    """ret / vol, null where vol is null or 0."""
    return F.when(vol != 0, ret / vol)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def rolling_avg(x: Column, w: WindowSpec, n: int) -> Column:
    """Mean of the last n rows, of as many as there are at the start."""
    return F.avg(x).over(last_rows(w, n))


def volatility(ret: Column, w: WindowSpec, n: int) -> Column:
    """Sample standard deviation of the last n rows; null with fewer than two values."""
    return F.stddev_samp(ret).over(last_rows(w, n))


def relative_strength(diff: Column, w: WindowSpec, n: int) -> Column:
    """100 - 100 / (1 + mean gain / mean loss) over n rows; a null difference counts as none."""
    gain = F.avg(F.when(diff > 0, diff).otherwise(0.0)).over(last_rows(w, n))
    loss = F.avg(F.when(diff < 0, -diff).otherwise(0.0)).over(last_rows(w, n))
    return strength(gain, loss)


def strength(gain: Column, loss: Column) -> Column:
    """100 - 100 / (1 + gain / loss)."""
    return F.lit(100.0) - ieee_div(F.lit(100.0), F.lit(1.0) + ieee_div(gain, loss))


def median_price(high: Column, low: Column) -> Column:
    return (high + low) / 2


def period_key(day: Column, frequency: str) -> Column:
    """A struct that names the week (ISO), month or quarter of a day."""
    if frequency == "weekly":
        return F.struct(F.extract(F.lit("YEAROFWEEK"), day).alias("year"), F.weekofyear(day).alias("part"))
    if frequency == "monthly":
        return F.struct(F.year(day).alias("year"), F.month(day).alias("part"))
    if frequency == "quarterly":
        return F.struct(F.year(day).alias("year"), F.floor((F.month(day) - 1) / 3).cast("int").alias("part"))
    raise ValueError(f"unknown frequency {frequency!r}")


def days_between(first: Column, last: Column) -> Column:
    """All days from first to last; an empty array if first comes after last."""
    none = F.array().cast("array<date>")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day"))).otherwise(none)


def lenient_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """A day, or null where the text is none."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def cut(x: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """The label of x among right-closed bins; null for null."""
    edges = sorted(edges)
    if labels is None:
        bounds = ["-inf", *(f"{e:g}" for e in edges), "inf"]
        labels = [f"({a}, {b}]" for a, b in zip(bounds, bounds[1:])]
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} labels, not {len(labels)}")
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x <= edge, label)
    return out.otherwise(labels[-1])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column, floor: float = 1e-12) -> Column:
    """Cosine similarity of two arrays of doubles."""
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + floor)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation as an aggregate; null where either side has no spread."""
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.when(spread > 0, F.covar_samp(x, y) / spread)
