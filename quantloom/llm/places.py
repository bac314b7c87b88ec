"""Places and running totals inside groups of any size, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, partitions, saved


class Places:
    """The rows of ``df`` ordered by ``group`` (without nulls) and ``order``.

    Rows are dealt by ranges of (group, order), so a hot group fills many tasks; only a count and a sum for each
    part and group are then added up along the parts. Rows that are equal in everything are dealt apart by
    their place in ``df``, which should be a saved table, as it is read twice.

    ``groups`` has a row a group: its key, ``rank_`` (among the groups, from 0), ``group_rows_`` and ``group_sum_``.
    """

    def __init__(self, df: DataFrame, group: str, order: list[str], value: str | None = None):
        self.group, self.value = group, value
        parts = partitions(df.sparkSession)
        by = [F.col(group), *[F.col(c) for c in order], F.col("in_")]
        dealt = df.withColumn("in_", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("in_")
        self._rows = saved(dealt.withColumn("part_", F.spark_partition_id()).withColumn("row_", F.monotonically_increasing_id()), "placed")
        self._amount = F.col(value).cast("long") if value else F.lit(0).cast("long")
        totals = self._rows.groupBy("part_", group).agg(F.count(F.lit(1)).alias("n_"), F.min("row_").alias("first_"), F.coalesce(F.sum(self._amount), F.lit(0)).alias("sum_"))
        along, whole = Window.partitionBy(group).orderBy("part_"), Window.partitionBy(group)
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select(
            "part_", group, "first_",
            F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("n_before_"), F.coalesce(F.sum("sum_").over(earlier), F.lit(0)).alias("sum_before_"),
            F.sum("n_").over(whole).alias("group_rows_"), F.sum("sum_").over(whole).alias("group_sum_"),
            (F.row_number().over(along) == 1).cast("long").alias("starts_"),
        )
        totals = saved(totals, "totals")
        started = totals.groupBy("part_").agg(F.sum("starts_").alias("s"))  # a row a part
        started = started.select("part_", (F.sum("s").over(Window.orderBy("part_")) - F.col("s")).alias("started_"))
        inside = Window.partitionBy("part_").orderBy(group).rowsBetween(Window.unboundedPreceding, 0)
        ranked = totals.join(started, "part_").withColumn("rank_", F.col("started_") + F.sum("starts_").over(inside) - 1).drop("started_")
        self._ranked = saved(ranked, "ranked")
        forget(totals)
        self.groups = self._ranked.where("starts_ = 1").select(group, "rank_", "group_rows_", "group_sum_")

    def rows(self, of_groups: DataFrame | None = None) -> DataFrame:
        """The rows with ``row_`` (unique), ``pos_`` (in the group, from 0), ``rank_``, ``group_rows_``, ``group_sum_`` and,
        of the summed column, ``before_`` (over the group's earlier rows).

        ``of_groups`` may give each group more columns, by ``group``. They go to a group's parts first, so that its rows
        meet them part by part and a hot group fills no task.
        """
        ranked = self._ranked.drop("starts_")
        if of_groups is not None:
            ranked = ranked.join(of_groups, self.group)
        out = self._rows.join(ranked, ["part_", self.group]).withColumn("pos_", F.col("n_before_") + F.col("row_") - F.col("first_"))
        if self.value:
            mine = Window.partitionBy("part_", self.group).orderBy("row_").rowsBetween(Window.unboundedPreceding, 0)
            out = out.withColumn("before_", F.col("sum_before_") + F.sum(self._amount).over(mine) - self._amount)
        return out.drop("part_", "first_", "n_before_", "sum_before_")

    def forget(self) -> None:
        """Delete the tables behind it, once nothing reads them any more."""
        forget(self._rows, self._ranked)
