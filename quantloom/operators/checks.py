"""Data-quality checks: each takes a DataFrame and returns the rows that violate it; none means it holds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import any_of, days_between, is_finite
from .asof import range_join

Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Fused:
    """A check that aggregates decide: ``part`` of some rows, ``whole`` of parts, and from that the number of ``violations``.
    ``report`` takes all such checks of a table from one scan; called on a table it gives the violating rows."""

    rows: Check
    part: Column
    whole: Callable[[str], Column] = F.sum
    violations: Callable[[Column], Column] = lambda n: F.coalesce(n, F.lit(0))

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.rows(df)


def _where(violates: Column) -> Fused:
    return Fused(lambda df: df.where(violates), F.count_if(violates))


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def not_null(*columns: str) -> Check:
    """One row with the number of rows that have a null, if there are any."""
    missing = F.count_if(any_of([F.col(c).isNull() for c in columns]))
    return Fused(lambda df: df.agg(missing.alias("violating_rows")).where("violating_rows > 0"), missing)


def list_length(column: str, n: int) -> Check:
    violates = (F.size(column) != n) & F.col(column).isNotNull()
    return Fused(lambda df: df.withColumn("actual_length", F.size(column)).where(violates), F.count_if(violates))


def in_range(column: str, low=None, high=None) -> Check:
    """Below low or above high; null passes, NaN is above."""
    if low is None and high is None:
        raise ValueError("a bound is needed")
    parts = ([F.col(column) < low] if low is not None else []) + ([F.col(column) > high] if high is not None else [])
    return _where(any_of(parts))


def freshness(column: str, max_days: int, as_of: Column) -> Check:
    late = lambda latest: F.datediff(as_of, latest) > max_days
    latest = F.max(column).cast("date")
    return Fused(lambda df: df.agg(latest.alias("latest")).where(late(F.col("latest"))), latest, F.max, lambda x: F.when(late(x), 1).otherwise(0))


def accepted_values(column: str, values: Sequence) -> Check:
    return _where(~F.col(column).isin(*values))


def rejected_values(column: str, values: Sequence) -> Check:
    return _where(F.col(column).isin(*values))


_OPERATIONS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


def comparison(a: str | Column, op: str, b: str | Column) -> Check:
    """Rows where ``a op b`` is false; null passes."""
    holds = _OPERATIONS[op](_col(a), _col(b))
    return _where(~holds)


def column_comparison(a: str, op: str, b: str) -> Check:
    return comparison(a, op, b)


@dataclass(frozen=True)
class foreign_key:  # noqa: N801  reads as a check like the others
    """Rows without a partner in ``target``."""

    columns: Sequence[str]
    target: DataFrame
    target_columns: Sequence[str] | None = None

    def partners(self) -> DataFrame:
        return self.target.select(*[F.col(t).alias(c) for c, t in zip(self.columns, self.target_columns or self.columns)])

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.join(self.partners(), list(self.columns), "left_anti")


def not_empty() -> Check:
    n = F.count(F.lit(1))
    return Fused(lambda df: df.agg(n.alias("rows")).where("rows = 0"), n, F.sum, lambda n: F.when(F.coalesce(n, F.lit(0)) == 0, 1).otherwise(0))


def finite(*columns: str) -> Check:
    return _where(any_of([~is_finite(F.col(c)) for c in columns]))


def matches(column: str, pattern: str) -> Check:
    return _where(~F.col(column).rlike(f"^(?:{pattern})$"))


@dataclass(frozen=True)
class no_gaps:  # noqa: N801
    """Days between a group's first and last that it has no row for."""

    day: str
    by: Sequence[str]
    skip_weekends: bool = False

    def __call__(self, df: DataFrame) -> DataFrame:
        bounds = df.groupBy(*self.by).agg(F.min(self.day).alias("a"), F.max(self.day).alias("b"))
        every = bounds.select(*self.by, F.explode(days_between(F.col("a"), F.col("b"))).alias(self.day))
        if self.skip_weekends:
            every = every.where(F.weekday(self.day) < 5)
        return every.join(df.select(*self.by, self.day), [*self.by, self.day], "left_anti")

    def expected(self) -> Column:
        """How many days a group should have, from its first and last day ``a`` and ``b``."""
        days = days_between(F.col("a"), F.col("b"))
        return F.size(F.filter(days, lambda x: F.weekday(x) < 5) if self.skip_weekends else days)


class unique:  # noqa: N801
    """Every row of a key that occurs more than once."""

    def __init__(self, *columns: str):
        self.columns = columns

    def __call__(self, df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*self.columns)
        return df.withColumn("__n", F.count(F.lit(1)).over(w)).where("__n > 1").drop("__n")


def no_negative(*columns: str) -> Check:
    return _where(any_of([F.col(c) < 0 for c in columns]))


def continuity(day: str, key: str) -> Check:
    """Days of the whole calendar, from a key's first day on, that it has no row for."""

    def run(df: DataFrame) -> DataFrame:
        first = df.groupBy(key).agg(F.min(day).alias("__first"))
        expected = range_join(first, df.select(day).distinct(), "__first", day).select(key, day)
        return expected.join(df.select(key, day), [key, day], "left_anti")

    return run


@dataclass(frozen=True)
class Ranges:
    """What a table of days was made of: ``rows`` that each stand for a row for every day from ``first`` to ``last``, in column ``day``."""

    rows: DataFrame
    first: str
    last: str
    day: str

    def stretches(self, by: Sequence[str]) -> DataFrame:
        """by, a, b, n: stretches of days of each key, from ``a`` to ``b``, and the number n of its ranges that hold them, which is not 0.

        A range is two rows, so this grows with ranges, not with days.
        """
        kept = self.rows.where(F.col(self.first) <= F.col(self.last))
        turns = F.array(F.struct(F.col(self.first).alias("a"), F.lit(1).alias("n")), F.struct(F.date_add(self.last, 1).alias("a"), F.lit(-1).alias("n")))
        at = kept.select(*by, F.explode(turns).alias("t")).select(*by, "t.*").groupBy(*by, "a").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*by).orderBy("a")
        held = at.select(*by, "a", F.date_sub(F.lead("a").over(w), 1).alias("b"), F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"))
        return held.where("n > 0")


def _one_scan(df: DataFrame, checks: Mapping[str, Check], ranges: Ranges | None = None) -> tuple[DataFrame | None, set[str]]:
    """One row with the violations of every check that a single pass over ``df`` decides, and these checks' names.

    Foreign keys are left joins with the distinct partners; a first ``unique`` groups the pass by its key, and a ``no_gaps`` over
    the same columns groups that by its own; the rest are aggregates that are added up along the way. Where ``ranges`` made the
    days of the key, these two take its stretches of days, and the days are added up where they are made.
    """
    parts: dict[str, tuple[Column, Callable[[str], Column], Callable[[Column], Column]]] = {}
    main = next(((k, c) for k, c in checks.items() if isinstance(c, unique)), None)
    gaps = next(((k, c) for k, c in checks.items() if main and isinstance(c, no_gaps) and {c.day, *c.by} == set(main[1].columns)), None)
    marked = df
    for i, (name, c) in enumerate(checks.items()):
        if isinstance(c, foreign_key):
            flag = f"__there{i}"
            marked = marked.join(c.partners().distinct().withColumn(flag, F.lit(True)), list(c.columns), "left")
            parts[name] = (F.count_if(F.col(flag).isNull()), F.sum, lambda n: F.coalesce(n, F.lit(0)))
        elif isinstance(c, Fused):
            parts[name] = (c.part, c.whole, c.violations)
    if main is None and not parts:
        return None, set()
    named = {name: f"__p{i}" for i, name in enumerate(parts)}
    firsts = [part.alias(named[k]) for k, (part, _, _) in parts.items()]
    sums = lambda extra: [whole(named[k]).alias(named[k]) for k, (_, whole, _) in parts.items()] + [F.sum(c).alias(c) for c in extra]
    none = lambda n: F.coalesce(n, F.lit(0))
    ends = {k: (named[k], violations) for k, (_, _, violations) in parts.items()}
    if main is None:
        stats = marked.agg(*firsts)
    elif ranges is not None and ranges.day in main[1].columns and len(main[1].columns) > 1:
        by = [c for c in main[1].columns if c != ranges.day]
        length = F.datediff("b", "a") + 1
        ends[main[0]] = ("__twice", none)
        keys = ranges.stretches(by)
        if gaps is None or gaps[1].day != ranges.day:
            keys, gaps = keys.agg(F.sum(F.when(F.col("n") > 1, F.col("n") * length)).alias("__twice")), None
        else:
            name, c = gaps
            keys = keys.withColumn("__days", c.expected()).groupBy(*by).agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("__days").alias("__days"), F.sum(F.when(F.col("n") > 1, F.col("n") * length)).alias("__twice"))
            known = F.when(any_of([F.col(x).isNull() for x in by]), 0).otherwise(F.col("__days"))
            keys = keys.agg(F.sum("__twice").alias("__twice"), F.sum(c.expected() - known).alias("__gaps"))
            ends[name] = ("__gaps", none)
        stats = (marked.agg(*firsts) if firsts else df.sparkSession.range(1)).crossJoin(keys)  # a row each
    else:
        name, key = main
        stats = marked.groupBy(*key.columns).agg(F.count(F.lit(1)).alias("__n"), *firsts)
        stats = stats.withColumn("__twice", F.when(F.col("__n") > 1, F.col("__n")).otherwise(0))
        ends[name], extra = ("__twice", none), ["__twice"]
        if gaps is not None:
            name, c = gaps
            own = F.weekday(c.day) < 5 if c.skip_weekends else F.col(c.day).isNotNull()
            stats = stats.groupBy(*c.by).agg(F.min(c.day).alias("a"), F.max(c.day).alias("b"), F.count_if(own).alias("__days"), *sums(extra))
            known = F.when(any_of([F.col(x).isNull() for x in c.by]), 0).otherwise(F.col("__days"))
            stats = stats.withColumn("__gaps", c.expected() - known)
            ends[name] = ("__gaps", none)
            extra = [*extra, "__gaps"]
        stats = stats.agg(*sums(extra))
    return stats.select(*[violations(F.col(c)).cast("long").alias(k) for k, (c, violations) in ends.items()]), set(ends)


def report(df: DataFrame, checks: Mapping[str, Check], ranges: Ranges | None = None) -> DataFrame:
    """(check, violations) for all checks, as one table; null violations where a check can't be planned.

    ``not_null`` counts rows with a null, ``not_empty`` and ``freshness`` 1 if they fail. All checks of this module but a second ``unique``,
    ``no_gaps`` without a ``unique`` over its columns, and ``continuity`` share one scan; other callables take one each.
    Of a table of days ``ranges`` says what they were made of, so that no day is moved.
    """
    spark = df.sparkSession
    planned: dict[str, Check] = {}
    out = []
    for name, check in checks.items():
        try:
            check(df).schema  # noqa: B018  a missing column shows here
            planned[name] = check
        except Exception:  # a check that can't run has failed
            out.append(spark.range(1).select(F.lit(name).alias("check"), F.lit(None).cast("long").alias("violations")))
    stats, done = _one_scan(df, planned, ranges)
    if stats is not None:
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("violations")) for c in stats.columns]))
        out.append(stats.select(rows.alias("r")).select("r.check", "r.violations"))
    out += [check(df).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations") for name, check in planned.items() if name not in done]
    return reduce(lambda a, b: a.unionByName(b), out)


def roll_up(reports: Mapping[str, DataFrame]) -> DataFrame:
    """(table, checks, failed, violations) from the reports of several tables; a check that couldn't run has failed."""
    tagged = reduce(lambda a, b: a.unionByName(b), [r.withColumn("table", F.lit(name)) for name, r in reports.items()])
    failed = F.count_if(F.col("violations").isNull() | (F.col("violations") > 0))
    return tagged.groupBy("table").agg(F.count(F.lit(1)).alias("checks"), failed.alias("failed"), F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))


def run_checks(df: DataFrame, checks: Mapping[str, Check]) -> None:
    """Raise one error that lists the checks that fail."""
    try:
        found = {r.check: r.violations for r in report(df, checks).collect()}
    except Exception:  # one of them fails on some row; find out which
        found = {}
        for name, check in checks.items():
            try:
                found[name] = check(df).count()
            except Exception:
                found[name] = None
    failed = [f"{name}: {'it could not run' if found[name] is None else f'{found[name]} rows'}" for name in checks if found[name] is None or found[name]]
    if failed:
        raise AssertionError("; ".join(failed))
