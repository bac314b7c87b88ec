"""Visibility graphs of price windows as edge lists, and measures on them.

A graph has the points of one symbol in one window, a few dozen at most, so pairs within a graph are
bounded by the window's length and the work spreads over windows and symbols.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("window_end", "symbol")
CELLS = 1 << 22  # graphs that are searched together have about as many pairs of nodes


def graph_points(rows: DataFrame, value: str = "open") -> DataFrame:
    """(window_end, symbol, i, y, n): points in time order; graphs of one point go."""
    w = Window.partitionBy(*KEYS)
    return rows.select(*KEYS, (F.row_number().over(w.orderBy("timeframe")) - 1).alias("i"), F.col(value).alias("y"), F.count(F.lit(1)).over(w).alias("n")).where("n > 1")


def visibility_edges(points: DataFrame) -> DataFrame:
    """(window_end, symbol, i, j), i < j: all points between lie below the line, so the slope to j is above all slopes to points before j."""
    later = points.select(*KEYS, F.col("i").alias("j"), F.col("y").alias("z"))
    pairs = points.join(later, list(KEYS)).where("i < j").withColumn("slope", (F.col("z") - F.col("y")) / (F.col("j") - F.col("i")))
    w = Window.partitionBy(*KEYS, "i").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    return pairs.withColumn("before", F.max("slope").over(w)).where("before is null or slope is null or slope > before").select(*KEYS, "i", "j")


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(*KEYS, F.col("i").alias("u"), F.col("j").alias("v")).union(edges.select(*KEYS, F.col("j").alias("u"), F.col("i").alias("v")))


def density(points: DataFrame, edges: DataFrame) -> DataFrame:
    n = points.groupBy(*KEYS).agg(F.max("n").alias("n"))
    m = edges.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("m"))
    return n.join(m, list(KEYS)).select(*KEYS, (2 * F.col("m") / (F.col("n") * (F.col("n") - 1))).alias("density"), (2 * F.col("m") / F.col("n")).alias("mean_degree"))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(*KEYS, "u").agg(F.count(F.lit(1)).alias("k"))


def clustering(edges: DataFrame) -> DataFrame:
    """Mean over all nodes of closed pairs of neighbours by all pairs."""
    b = both_ways(edges)
    wedges = b.join(b.withColumnRenamed("v", "w"), [*KEYS, "u"]).where("v < w")
    closed = wedges.join(edges.select(*KEYS, F.col("i").alias("v"), F.col("j").alias("w")), [*KEYS, "v", "w"]).groupBy(*KEYS, "u").agg(F.count(F.lit(1)).alias("t"))
    k = degrees(edges)
    share = F.when(F.col("k") > 1, 2 * F.coalesce("t", F.lit(0)) / (F.col("k") * (F.col("k") - 1))).otherwise(0.0)
    return k.join(closed, [*KEYS, "u"], "left").groupBy(*KEYS).agg(F.avg(share).alias("clustering"))


def assortativity(edges: DataFrame) -> DataFrame:
    """Correlation of the degrees at an edge's ends, from whole sums with one division; null where all degrees are equal."""
    k = degrees(edges)
    ends = both_ways(edges).join(k.withColumnRenamed("k", "ku"), [*KEYS, "u"]).join(k.select(*KEYS, F.col("u").alias("v"), F.col("k").alias("kv")), [*KEYS, "v"])
    sums = ends.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("ku * kv")).alias("uv"), F.sum("ku").alias("s"), F.sum(F.expr("ku * ku")).alias("uu"))
    return sums.select(*KEYS, F.expr("CASE WHEN n * uu > s * s THEN (n * uv - s * s) / (n * uu - s * s) END").alias("assortativity"))


def power_law(edges: DataFrame) -> DataFrame:
    """Minus the slope of ln p(k) on ln k; null for fewer than two degrees."""
    counts = degrees(edges).groupBy(*KEYS, "k").agg(F.count(F.lit(1)).alias("c"))
    total = F.sum("c").over(Window.partitionBy(*KEYS))
    shares = counts.withColumn("p", F.col("c") / total)
    return shares.groupBy(*KEYS).agg(F.when(F.count(F.lit(1)) > 1, -F.regr_slope(F.ln("p"), F.ln("k"))).alias("exponent"))


def path_measures(edges: DataFrame) -> DataFrame:
    """(window_end, symbol, mean_path, mean_betweenness) of connected graphs, as visibility graphs are; others raise.

    A shortest path of length d has d - 1 nodes inside, so the betweenness of all nodes together follows from the
    distances alone. Graphs travel as rows, many to a batch; those of equal size are searched together, level by level, with
    the reached nodes as bits.
    """
    ends = F.array_sort(F.collect_list(F.struct(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"))))
    graphs = edges.groupBy(*KEYS).agg(ends.alias("e")).select(*KEYS, F.col("e.i").alias("i"), F.col("e.j").alias("j"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            firsts, seconds = f["i"].to_list(), f["j"].to_list()
            nodes = [np.unique(np.concatenate([a, b]), return_inverse=True) for a, b in zip(firsts, seconds)]
            sizes, total = np.array([len(own) for own, _ in nodes]), np.zeros(len(f))
            for n in np.unique(sizes):
                these = np.flatnonzero(sizes == n)
                for part in np.array_split(these, max(1, len(these) * n * n // CELLS + 1)):
                    if len(part):
                        total[part] = _distance_sums([nodes[g][1] for g in part], int(n))
            pairs = sizes * (sizes - 1)
            inside = np.divide(total - pairs, pairs * (sizes - 2), out=np.zeros(len(f)), where=sizes > 2)
            yield pd.DataFrame({"window_end": f["window_end"], "symbol": f["symbol"], "mean_path": total / pairs, "mean_betweenness": inside})

    return graphs.mapInPandas(run, "window_end date, symbol long, mean_path double, mean_betweenness double")


def _distance_sums(ends: list[np.ndarray], n: int) -> np.ndarray:
    """For each graph of ``n`` nodes the sum of the distances of all ordered pairs; ``ends`` has the edges' first ends, then their second ones."""
    graph = np.repeat(np.arange(len(ends)), [len(e) // 2 for e in ends])
    a, b = (np.concatenate([np.split(e, 2)[side] for e in ends]) for side in (0, 1))
    near = np.zeros((len(ends), n, n), bool)
    near[graph, a, b] = near[graph, b, a] = True
    return _distances(near)


def _distances(edges: np.ndarray) -> np.ndarray:
    """For each connected graph of ``edges[graph, u, v]`` the sum of the distances of all ordered pairs."""
    graphs, n = edges.shape[:2]
    words, lanes = (n + 63) // 64, np.uint64(1) << np.arange(64, dtype=np.uint64)
    near = edges.copy()
    near[:, np.arange(n), np.arange(n)] = True
    padded = np.zeros((graphs, n, words * 64), bool)
    padded[..., :n] = near
    bits = (padded.reshape(graphs, n, words, 64) * lanes).sum(axis=-1, dtype=np.uint64)  # the nodes within one step of each node
    full = np.full(graphs, n * n)
    reached, total = bits.copy(), n * n - n + np.zeros(graphs, np.int64)
    for _ in range(n):
        count = np.bitwise_count(reached).sum(axis=(1, 2), dtype=np.int64)
        if (count == full).all():
            return total
        total += full - count  # pairs that are further than this level
        after = reached.copy()
        for v in range(n):  # a node reaches what its neighbours reached
            after |= np.where(near[:, :, v, None], reached[:, v, None, :], np.uint64(0))
        reached = after
    raise ValueError("a graph is not connected")


def visibility_measures(points: DataFrame, edges: DataFrame) -> DataFrame:
    out = density(points, edges)
    for part in (clustering(edges), assortativity(edges), power_law(edges), path_measures(edges)):
        out = out.join(part, list(KEYS), "left")
    return out


# --- all measures of a graph from its points, a row a graph
MEASURES = ("density", "mean_degree", "clustering", "assortativity", "exponent", "mean_path", "mean_betweenness")


def graph_rows(rows: DataFrame, value: str = "open") -> DataFrame:
    """(window_end, symbol, y): a row for each graph with its points' values in time order; graphs of one point go."""
    points = F.array_sort(F.collect_list(F.struct("timeframe", F.col(value).cast("double").alias("y"))))
    return rows.groupBy(*KEYS).agg(points.alias("p")).where("size(p) > 1").select(*KEYS, F.col("p.y").alias("y"))


def graph_measures(graphs: DataFrame, names: Sequence[str] = MEASURES) -> DataFrame:
    """(window_end, symbol, names...) of ``graph_rows``, equal to the measures of ``visibility_edges``.

    Edges are never rows: a task finds those of its graphs, of equal size together, and takes the measures from them.
    """
    schema = ", ".join([f"{k} {graphs.schema[k].dataType.simpleString()}" for k in KEYS] + [f"{c} double" for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("y")
            starts, sizes = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
            y, lost = lists.values.to_numpy(zero_copy_only=False), lists.values.is_null().to_numpy(zero_copy_only=False)
            out, none = np.zeros((len(names), len(sizes))), np.zeros((len(names), len(sizes)), bool)
            for n in np.unique(sizes):
                these = np.flatnonzero(sizes == n)
                for part in np.array_split(these, len(these) * n * n // CELLS + 1):
                    at = starts[part, None] + np.arange(n)
                    for c, (v, gone) in enumerate(_measured(_visible(y[at], lost[at]), names)):
                        out[c, part], none[c, part] = v, gone
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in KEYS], *[pa.array(v, mask=m) for v, m in zip(out, none)]], [*KEYS, *names])

    return graphs.mapInArrow(run, schema)


def _visible(y: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """edges[graph, u, v] of ``y[graph, point]``: a slope is above all those to points between. As in SQL, NaN is above all numbers, and null neither hides nor is hidden."""
    n = y.shape[1]
    edges = np.zeros((len(y), n, n), bool)
    with np.errstate(all="ignore"):
        for i in range(n - 1):
            slope, null = (y[:, i + 1 :] - y[:, i, None]) / np.arange(1, n - i), lost[:, i + 1 :] | lost[:, i, None]
            odd = np.isnan(slope) & ~null
            plain = ~odd & ~null
            highest = np.maximum.accumulate(np.where(plain, slope, -np.inf), axis=1)[:, :-1]
            some, odd_before = (np.logical_or.accumulate(m, axis=1)[:, :-1] for m in (plain, odd))
            hidden = ~null[:, 1:] & (odd_before | plain[:, 1:] & some & (highest >= slope[:, 1:]))
            edges[:, i, i + 1] = True
            edges[:, i, i + 2 :] = ~hidden
    return edges | edges.transpose(0, 2, 1)


def _measured(edges: np.ndarray, names: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each name the values, and where they are null."""
    graphs, n = edges.shape[:2]
    k = edges.sum(axis=2)  # degrees
    twice, never, paths = k.sum(axis=1), np.zeros(graphs, bool), None
    for name in names:
        if name == "density":
            yield twice / (n * (n - 1)), never
        elif name == "mean_degree":
            yield twice / n, never
        elif name == "clustering":
            e = edges.astype(np.float64)
            closed = ((e @ e) * e).sum(axis=2)  # twice the closed pairs of neighbours
            yield np.where(k > 1, closed / np.maximum(k * (k - 1), 1), 0.0).mean(axis=1), never
        elif name == "assortativity":
            s, uu, uv = (k * k).sum(axis=1), (k**3).sum(axis=1), (k[:, :, None] * k[:, None, :] * edges).sum(axis=(1, 2))
            spread = twice * uu - s * s
            yield (twice * uv - s * s) / np.where(spread > 0, spread, 1), spread <= 0
        elif name == "exponent":
            c = np.bincount((np.arange(graphs)[:, None] * n + k).ravel(), minlength=graphs * n).reshape(graphs, n)
            there = c > 0
            x, y = np.log(np.maximum(np.arange(n), 1)), np.log(np.where(there, c / n, 1))
            kinds = there.sum(axis=1)
            dx = np.where(there, x - (there * x).sum(axis=1, keepdims=True) / kinds[:, None], 0.0)
            dy = np.where(there, y - y.sum(axis=1, keepdims=True) / kinds[:, None], 0.0)
            yield -(dx * dy).sum(axis=1) / np.where(kinds > 1, (dx * dx).sum(axis=1), 1), kinds < 2
        elif name in ("mean_path", "mean_betweenness"):
            paths, pairs = _distances(edges) if paths is None else paths, n * (n - 1)
            yield (paths / pairs if name == "mean_path" else (paths - pairs) / max(pairs * (n - 2), 1)), never
        else:
            raise ValueError(f"unknown measure {name!r}")
