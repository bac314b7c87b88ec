"""As-of join and point-in-time validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, running_states


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, keep: Sequence[str], each: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Each left row with the columns ``keep`` of the latest right row of its key at or before its time, null if there is none.

    Both sides are merged by key and time and the last right row is carried forward, so a key's right
    rows are never multiplied with its left rows. Right keys should be unique per time; of several, the
    greatest values of ``keep`` win. With ``each``, every column goes on with its own latest value that is not null.
    A key with more than ``hot_rows`` rows is cut into blocks of time.
    """
    packed = F.struct(*[F.col(c) for c in keep])
    here = left.select(*by, F.col(left_on).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType).alias("__found"))
    there = right.select(*by, F.col(right_on).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(here.schema["__row"].dataType).alias("__row"), packed.alias("__found")).where(F.col("__t").isNotNull())
    states = {f"__k_{c}": ("last", F.col(f"__found.{c}")) for c in keep} if each else {"__found_": ("last", F.col("__found"))}
    met = running_states(here.union(there), by, ["__t", "__side", "__found"], states, hot_rows).where("__side = 1")
    found = (lambda c: F.col(f"__k_{c}")) if each else (lambda c: F.col(f"__found_.{c}"))
    lost = F.col("__t").isNull() | reduce_any_null(by)
    return met.select("__row.*", *[F.when(~lost, found(c)).alias(c) for c in keep])


def reduce_any_null(names: Sequence[str]):
    out = F.lit(False)
    for n in names:
        out = out | F.col(n).isNull()
    return out


def valid_ranges(facts: DataFrame, key: str, filed: str, order: Sequence[str], as_of) -> DataFrame:
    """``facts`` with valid_from (the filing day) and valid_until (the day before the key's next filing, as_of for the last).

    Of several entries on one filing day the last by ``order`` wins; entries filed after as_of go.
    """
    known = facts.where(F.col(filed) <= as_of)
    latest = Window.partitionBy(key, filed).orderBy(*[F.desc(c) for c in order])
    one = known.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n")
    after = F.lead(filed).over(Window.partitionBy(key).orderBy(filed))
    return one.withColumn("valid_from", F.col(filed)).withColumn("valid_until", F.coalesce(F.date_sub(after, 1), as_of))


def pad_daily(ranges: DataFrame, day: str = "reference_date") -> DataFrame:
    """A row for each day of each range."""
    from ..functions.expr import days_between

    return ranges.withColumn(day, F.explode(days_between(F.col("valid_from"), F.col("valid_until"))))


def range_join(left: DataFrame, right: DataFrame, start: str, at: str, width_days: int = 32) -> DataFrame:
    """Every left row with every right row whose day ``at`` is not before the left row's day ``start``.

    Days are cut into buckets. A left row meets its own bucket, where days are compared, and each later one, where all
    days count; so this is an equality join on buckets, dealt out by them, and not a loop over all pairs. Null days meet nothing.
    The sides should have no column names in common; an empty side gives no rows.
    """
    last = right.agg(F.max(at)).first()[0]
    bucket = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / width_days)
    own = left.withColumn("__own", bucket(F.col(start))).where(F.col(start) <= F.lit(last).cast("date"))
    own = own.withColumn("__bucket", F.explode(F.sequence("__own", bucket(F.lit(last).cast("date")))))
    met = own.join(right.withColumn("__bucket", bucket(F.col(at))), "__bucket")
    return met.where((F.col("__bucket") > F.col("__own")) | (F.col(at) >= F.col(start))).drop("__own", "__bucket")
