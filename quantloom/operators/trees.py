"""Decision trees for a whole grid of parameters, grown together from histograms.

Features are cut into a few bins once. A level costs one pass: each task counts (tree, node, feature, bin, class) over its
rows in numpy, the counts are added up by a shuffle, and each node's best split is found from its own counts. Trees of the
grid that have made the same splits so far are one tree, and a shallow tree is the top of a deep one, so a combination
costs a histogram of its own only from where it differs. The driver keeps splits, at most two to the depth for each tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.writers import brief_shuffles, written

BINS = 32
LEAST_GAIN = 1e-12
DEFAULTS = {"maxDepth": 5, "impurity": "gini", "minSamplesSplit": 2, "classWeight": "none"}
Splits = dict[int, tuple[int, int]]  # node: (feature, last bin that goes left); the root is 1, the children of k are 2k and 2k + 1


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """For each feature the distinct values at equal shares of the rows, less than ``bins``."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = df.agg(*[F.approx_percentile(F.col(c).cast("double"), shares, F.lit(100 * bins)).alias(f"e{i}") for i, c in enumerate(features)]).first()
    return [sorted({x for x in edges or [] if x == x}) for edges in found]


def _binned(df: DataFrame, features: Sequence[str], edges: list[list[float]], label: str, held: str) -> DataFrame:
    """(bins, label, held): a row's bins, its class, and whether it judges. Null and NaN are in the last bin."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.select(F.col(label).alias("label"), F.col(held).alias("held"), *values).where("held is not null and label is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [c.to_numpy() for c in batch.columns[2:]]
            bins = np.stack([np.where(np.isnan(v), len(own), np.searchsorted(own, v)) for v, own in zip(values, edges)], axis=1).astype(np.int8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1, dtype=np.int32) * len(edges)), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([lists, *batch.columns[:2]], ["bins", "label", "held"])

    return rows.mapInArrow(cut, T.StructType([T.StructField("bins", T.ArrayType(T.ByteType())), rows.schema["label"], rows.schema["held"]]))


def _nodes(bins: np.ndarray, splits: Splits, depth: int) -> np.ndarray:
    """The node at ``depth``, or the leaf above it, that each row is in."""
    node = np.ones(len(bins), np.int64)
    size = max(splits, default=0) + 1
    feature, last = np.full(size, -1), np.zeros(size, np.int64)
    for k, (f, b) in splits.items():
        feature[k], last[k] = f, b
    for _ in range(depth):
        inside = node < size
        at = np.where(inside, node, 0)
        f = np.where(inside, feature[at], -1)
        right = bins[np.arange(len(bins)), np.maximum(f, 0)] > last[at]
        node = np.where(f >= 0, 2 * node + right, node)
    return node


def _histograms(rows: DataFrame, trees: list[Splits], level: int, n_features: int, n_classes: int) -> DataFrame:
    """(tree, node, feature, bin, y, n) of the nodes on ``level``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        low = 1 << level
        for batch in batches:
            bins, y = np.stack(batch["bins"].to_list()), batch["y"].to_numpy()
            for t, splits in enumerate(trees):
                node = _nodes(bins, splits, level)
                here = node >= low
                cell = (((node[here, None] - low) * n_features + np.arange(n_features)) * BINS + bins[here]) * n_classes + y[here, None]
                size = low * n_features * BINS * n_classes
                part = total.setdefault(t, np.zeros(size, np.int64))
                part += np.bincount(cell.ravel(), minlength=size)
        for t, part in total.items():
            at = np.flatnonzero(part)
            rest, y = np.divmod(at, n_classes)
            rest, b = np.divmod(rest, BINS)
            node, f = np.divmod(rest, n_features)
            yield pd.DataFrame({"tree": t, "node": node + low, "feature": f, "bin": b, "y": y, "n": part[at]})

    parts = rows.mapInPandas(count, "tree long, node long, feature long, bin long, y long, n long")
    return parts.groupBy("tree", "node", "feature", "bin", "y").agg(F.sum("n").alias("n"))


def impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy (in bits) of weighted class counts on the last axis."""
    total = counts.sum(axis=-1, keepdims=True)
    p = counts / np.where(total > 0, total, 1)
    if kind == "gini":
        return 1 - (p**2).sum(axis=-1)
    return -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=-1)


def best_split(counts: np.ndarray, weights: np.ndarray, kind: str) -> tuple[int, int] | None:
    """(feature, last bin on the left) of ``counts[feature, bin, class]`` that lowers the weighted impurity most; ties to the first."""
    left = np.cumsum(counts * weights, axis=1)[:, :-1]
    whole = (counts[0] * weights).sum(axis=0)
    right = whole - left
    nl, nr = left.sum(axis=-1), right.sum(axis=-1)
    gain = impurity(whole, kind) - (nl * impurity(left, kind) + nr * impurity(right, kind)) / max(whole.sum(), 1e-300)
    held = counts.cumsum(axis=1)[:, :-1].sum(axis=-1)
    gain = np.where((held > 0) & (held < counts[0].sum()), gain, -1.0)
    f, b = divmod(int(np.argmax(np.round(gain, 12))), gain.shape[1])
    return (f, b) if gain[f, b] > LEAST_GAIN else None


def class_weights_of(kind: str, n: np.ndarray) -> np.ndarray:
    """Weights of the classes in order: none, balanced, or 2 for the two last (``weight-top``) or first ones (``weight-bottom``)."""
    if kind == "balanced":
        return n.sum() / (len(n) * np.maximum(n, 1))
    out = np.ones(len(n))
    if kind == "weight-top":
        out[-2:] = 2
    elif kind == "weight-bottom":
        out[:2] = 2
    elif kind != "none":
        raise ValueError(f"unknown class weights {kind!r}")
    return out


def _chooser(members: dict[int, list[tuple]], n_features: int, n_classes: int):
    """For one node's counts, the class and split (-1 for none) of each tree that shares them."""

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        tree, node = int(group["tree"].iloc[0]), int(group["node"].iloc[0])
        counts = np.zeros((n_features, BINS, n_classes))
        counts[group["feature"], group["bin"], group["y"]] = group["n"]
        own, out = counts[0].sum(axis=0), []
        for number, kind, least, weight in members[tree]:
            split = best_split(counts, weight, kind) if own.sum() >= least else None
            out.append((number, node, int(np.argmax(own * weight)), *(split or (-1, -1))))
        return pd.DataFrame(out, columns=["kind", "node", "y", "feature", "bin"])

    return choose


def tree_grid(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence]) -> DataFrame:
    """(parameters, accuracy, macro_f1) on ``test`` of a tree for each combination of ``grid`` over the keys of DEFAULTS.

    A node is split if it has ``minSamplesSplit`` rows and a split lowers its impurity. Ties go to the first feature, bin and class.
    Rows of ``test`` with classes that ``train`` lacks are left out; without any row, the measures are null. Without training rows there is no result.
    """
    part = lambda df, held: df.select(*features, label).withColumn("__held", F.lit(held))
    return split_grid(part(train, False).unionByName(part(test, True)), "__held", features, label, grid)


def split_grid(df: DataFrame, held: str, features: Sequence[str], label: str, grid: Mapping[str, Sequence], read: Callable[[], None] = lambda: None) -> DataFrame:
    """``tree_grid`` of one table, whose rows with ``held`` judge and the others train.

    ``df`` is read twice, for the edges of bins and to write the bins, then ``read`` is called; no table of features is stored.
    """
    unknown = set(grid) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    combinations = [dict(zip(grid, values)) for values in product(*grid.values())]
    spark = df.sparkSession
    with brief_shuffles(spark):
        edges = bin_edges(df.where(~F.col(held)), features)
        binned = written(_binned(df, features, edges, label, held), "binned")
    read()
    found = binned.where("not held").groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").collect()  # a row a class
    if not found:
        return spark.createDataFrame([], "parameters string, accuracy double, macro_f1 double")
    classes, sizes = [r[0] for r in found], np.array([r.n for r in found])
    y = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1).cast("int").alias("y")
    rows, judged = (binned.where(c).select("bins", y).where("y >= 0") for c in ("not held", "held"))

    full = [DEFAULTS | c for c in combinations]
    depth_of: dict[tuple, int] = {}
    for c in full:
        kind = (c["impurity"], c["minSamplesSplit"], c["classWeight"])
        depth_of[kind] = max(depth_of.get(kind, 0), c["maxDepth"])
    kinds = list(depth_of)
    weights = {k: class_weights_of(k[2], sizes) for k in kinds}
    splits: dict[tuple, Splits] = {k: {} for k in kinds}
    leaves: dict[tuple, dict[int, int]] = {k: {} for k in kinds}  # each node's class
    n_features, n_classes = len(features), len(classes)
    growing = kinds
    for level in range(max(depth_of.values()) + 1):
        growing = [k for k in growing if depth_of[k] >= level and (level == 0 or any(n >= 1 << (level - 1) for n in splits[k]))]
        if not growing:
            break
        stems = list(dict.fromkeys(tuple(sorted(splits[k].items())) for k in growing))
        members = {t: [k for k in growing if tuple(sorted(splits[k].items())) == stem] for t, stem in enumerate(stems)}
        choose = _chooser({t: [(kinds.index(k), k[0], k[1], weights[k]) for k in own] for t, own in members.items()}, n_features, n_classes)
        counted = _histograms(rows, [dict(s) for s in stems], level, n_features, n_classes)
        with brief_shuffles(spark):
            chosen = counted.groupBy("tree", "node").applyInPandas(choose, "kind long, node long, y long, feature long, bin long").collect()  # a row a node
        for r in chosen:
            k = kinds[r.kind]
            leaves[k][r.node] = r.y
            if r.feature >= 0 and level < depth_of[k]:
                splits[k][r.node] = (r.feature, r.bin)

    chosen = [(c["maxDepth"], (c["impurity"], c["minSamplesSplit"], c["classWeight"])) for c in full]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins, y = np.stack(batch["bins"].to_list()), batch["y"].to_numpy()
            for i, (depth, k) in enumerate(chosen):
                guess = pd.Series(_nodes(bins, splits[k], depth)).map(leaves[k]).to_numpy()
                pairs, n = np.unique(y * n_classes + guess, return_counts=True)
                yield pd.DataFrame({"i": i, "l": pairs // n_classes, "p": pairs % n_classes, "n": n})

    counts = judged.mapInPandas(judge, "i long, l long, p long, n long").groupBy("i", "l", "p").agg(F.sum("n").alias("n"))
    both = counts.select("i", "n", (F.col("l") == F.col("p")).alias("hit"), F.explode(F.array(F.struct(F.col("l").alias("c"), F.lit(1).alias("own")), F.struct(F.col("p").alias("c"), F.lit(0).alias("own")))).alias("side"))
    of_class = both.groupBy("i", F.col("side.c").alias("c")).agg(F.sum("n").alias("twice"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("hits"))
    f1 = of_class.groupBy("i").agg(F.avg(F.col("hits") / F.col("twice")).alias("macro_f1"))  # a hit stands on both sides: 2 hits / (actual + guessed)
    accuracy = counts.groupBy("i").agg((F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    names = spark.createDataFrame([(i, str(c)) for i, c in enumerate(combinations)], "i long, parameters string")
    return names.join(accuracy, "i", "left").join(f1, "i", "left").orderBy("i").select("parameters", "accuracy", "macro_f1")
