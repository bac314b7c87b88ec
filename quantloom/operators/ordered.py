"""Ordered operators on keys of any size: places, trailing windows and running states.

A window function brings a key's rows into one task. Here only keys with few rows are treated so. Rows of a hot key
are dealt by ranges of (key, order), numbered from counts of the ranges, and cut into blocks of consecutive rows.
A trailing window needs the last rows of the block before, which are copied; a running state needs what
the blocks before add up to, one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import written

HOT_ROWS = 1 << 20  # a key with more rows is cut into blocks
BLOCK_ROWS = 1 << 13


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``__pos``: each row's place in its key, from 0; ties in no set order.

    The work table is dealt by ranges, so a hot key fills many tasks; a row for each range and key is added up along the ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = [*[F.col(c) for c in by], *[F.col(c) for c in order], F.col("__in")]
    dealt = df.withColumn("__in", F.monotonically_increasing_id()).repartitionByRange(parts, *ranges).sortWithinPartitions(*ranges).drop("__in")
    rows = written(dealt.withColumn("__part", F.spark_partition_id()).withColumn("__seq", F.monotonically_increasing_id()).withColumn("__key", F.struct(*by)), "ordered")
    counts = rows.groupBy("__part", "__key").agg(F.count(F.lit(1)).alias("n"), F.min("__seq").alias("__first"))
    earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", "__key", "__first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    met = rows.join(starts, ["__part", "__key"])
    return met.withColumn("__pos", F.col("__before") + F.col("__seq") - F.col("__first")).drop("__part", "__key", "__seq", "__first", "__before")


def _split(df: DataFrame, by: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with up to ``hot_rows`` rows, and those of the others if there are any.

    There are at most (rows / hot_rows) hot keys, so they are broadcast.
    """
    marked = written(df, "keyed")
    keys = marked.groupBy(F.struct(*by).alias("__key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("__key")
    keys = written(keys, "hot_keys")
    if keys.isEmpty():
        return marked, None
    tagged = marked.withColumn("__key", F.struct(*by))
    return tagged.join(F.broadcast(keys), "__key", "left_anti").drop("__key"), tagged.join(F.broadcast(keys), "__key", "left_semi").drop("__key")


def trailing_windows(df: DataFrame, by: Sequence[str], order: Sequence[str], reach: int, build: Callable[[DataFrame, list[str], list[str]], DataFrame], hot_rows: int | None = HOT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``build(df, keys, order)``, where no row needs more than the ``reach`` rows before it in its key.

    ``build`` adds columns and keeps rows and their columns; it is given the columns of a group, which is a key or a hot
    key's block, and those that order it. Without ``hot_rows`` each key is one group.
    """
    if hot_rows is None:
        return build(df, list(by), list(order))
    light, hot = _split(df, by, hot_rows)
    out = build(light, list(by), list(order))
    if hot is None:
        return out
    size = max(block_rows, 8 * reach, 1)
    rows = numbered(hot, by, order).withColumn("__block", F.expr(f"__pos div {size}"))
    here = rows.withColumn("__copy", F.lit(False))
    ahead = rows.where(F.col("__pos") % size >= size - reach).withColumn("__block", F.col("__block") + 1).withColumn("__copy", F.lit(True))
    built = build(here.unionByName(ahead), [*by, "__block"], ["__pos"])
    return out.unionByName(built.where("NOT __copy").drop("__copy", "__block", "__pos"))


_SINGLE = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}


def _added(kind: str, before: Column, here: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    if kind == "last":
        return F.coalesce(here, before)
    return F.greatest(before, here) if kind == "max" else F.least(before, here)


def running_states(df: DataFrame, by: Sequence[str], order: Sequence[str], states: Mapping[str, tuple[str, Column]], hot_rows: int | None = HOT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with, for each name, the state (kind, column) of its key up to and with the row: sum, count, max, min, or last (not null).

    ``order`` should be total. A key that is hot goes block by block; its blocks' states are added up one row a block.
    """
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    plain = upto(Window.partitionBy(*by).orderBy(*order))
    over = lambda w: {name: _SINGLE[kind](c).over(w) for name, (kind, c) in states.items()}
    if hot_rows is None:
        return df.withColumns(over(plain))
    light, hot = _split(df, by, hot_rows)
    out = light.withColumns(over(plain))
    if hot is None:
        return out
    rows = numbered(hot, by, order).withColumn("__block", F.struct(*by, F.expr(f"__pos div {block_rows}").alias("__n")))
    rows = rows.withColumns(over(upto(Window.partitionBy("__block").orderBy("__pos"))))
    ends = rows.groupBy("__block").agg(F.max_by(F.struct(*states), "__pos").alias("e"))  # the state at a block's end
    along = Window.partitionBy(*[f"__block.{c}" for c in by]).orderBy("__block.__n").rowsBetween(Window.unboundedPreceding, -1)
    carry = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}
    ends = ends.select("__block", *[carry[kind](f"e.{name}").over(along).alias(f"__c_{name}") for name, (kind, _) in states.items()])
    met = rows.join(ends, "__block")
    done = met.withColumns({name: _added(kind, F.col(f"__c_{name}"), F.col(name)) for name, (kind, _) in states.items()})
    return out.unionByName(done.select(*out.columns))
