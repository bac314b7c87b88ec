"""Places for intermediate tables, and small DataFrame helpers shared by the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import forget, new_path  # noqa: F401

HEAVY_SHARE = 4  # a key is heavy above one part in so many times the shuffle partitions


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and a lost
    executor costs no more than the stage that was running."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores behind as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bucket(column: str = "doc_id"):
    """crc32 of the id as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def heavy_keys(per_key: DataFrame, key: str, share: bool = False) -> DataFrame:
    """The keys of ``per_key(key, rows_)`` with more than one row in ``HEAVY_SHARE * partitions`` of all.

    There are fewer than ``HEAVY_SHARE * partitions`` of them, whatever the input, so they may be broadcast.
    With ``share``, ``share_`` tells how many such parts a key fills.
    """
    parts = HEAVY_SHARE * partitions(per_key.sparkSession)
    total = per_key.agg(F.sum("rows_")).first()[0] or 0
    heavy = per_key.where(F.col("rows_") * parts > total)
    return heavy.select(key, F.ceil(F.col("rows_") * parts / F.lit(max(1, total))).alias("share_")) if share else heavy


def join_by_key(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """``rows`` with the other columns of ``per_key``, which has one row a key and in ``rows_`` how many rows the key has.

    Heavy keys are joined by broadcast, so none of them fills a task; the others by shuffle.
    ``per_key`` should be a saved table, as it is read several times.
    """
    heavy = heavy_keys(per_key, key).drop("rows_")
    light = per_key.join(F.broadcast(heavy.select(key)), key, "left_anti").drop("rows_")
    return rows.join(F.broadcast(heavy), key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of ``links(a, b)``: ``(node, root)`` for every linked node, where root is
    the least node of its component.

    Alternating large-star and small-star rounds; a round reads and writes the edge table only. Minima
    are aggregated before the shuffle, and nodes with very many neighbours meet theirs by broadcast
    (``join_by_key``), so a hub fills no task.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        n = F.count(F.lit(1)).alias("rows_")
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), n), "least")
        large = saved(join_by_key(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lower = saved(large.groupBy("u").agg(F.min("v").alias("m"), n), "lower")
        small = join_by_key(large, lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, saved(small.union(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(last, least, large, lower)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last column of ``x`` is the constant and is not penalised.

    Without rows, all weights are 0. ``y`` may hold probabilities.
    """
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w
