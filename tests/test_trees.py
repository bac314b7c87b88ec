"""Trees of a grid against trees that are grown one by one, row by row."""

import math
from collections import Counter

import numpy as np
import pytest

from quantloom.operators import trees as T


def impurity(ys, weight, kind):
    total = sum(weight[y] for y in ys)
    shares = [n * weight[y] / total for y, n in Counter(ys).items()]
    return 1 - sum(p * p for p in shares) if kind == "gini" else -sum(p * math.log2(p) for p in shares)


def grow(rows, depth, kind, least, weight, n_features):
    """A function from bins to a class, by trying every split of every node."""
    ys = [y for _, y in rows]
    own = Counter(ys)
    leaf = min(own, key=lambda y: (-own[y] * weight[y], y))
    if depth == 0 or len(rows) < least:
        return lambda x: leaf
    best, at, total = T.LEAST_GAIN, None, sum(weight[y] for y in ys)
    for f in range(n_features):
        for b in sorted({x[f] for x, _ in rows})[:-1]:
            left, right = [y for x, y in rows if x[f] <= b], [y for x, y in rows if x[f] > b]
            cost = sum(sum(weight[y] for y in part) * impurity(part, weight, kind) for part in (left, right)) / total
            gain = impurity(ys, weight, kind) - cost
            if gain > best + 1e-10:
                best, at = gain, (f, b)
    if at is None:
        return lambda x: leaf
    f, b = at
    low, high = (grow([r for r in rows if (r[0][f] <= b) == side], depth - 1, kind, least, weight, n_features) for side in (True, False))
    return lambda x: low(x) if x[f] <= b else high(x)


def test_grid_against_trees_grown_alone(spark):
    rng = np.random.default_rng(6)
    names = ["down", "flat", "up"]
    data = [(float(a), float(b), float(c), names[int(rng.choice(3, p=[0.7, 0.2, 0.1] if a * b > 0 else [0.1, 0.3, 0.6] if c > 0.3 else [0.2, 0.6, 0.2]))]) for a, b, c in rng.normal(size=(600, 3)).round(1)]
    df = spark.createDataFrame(data, "a double, b double, c double, y string")
    train, test = spark.createDataFrame(data[:400], df.schema), spark.createDataFrame(data[400:] + [(0.0, 0.0, 0.0, "never seen")], df.schema)
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [0, 1, 4], "minSamplesSplit": [2, 60], "classWeight": ["none", "balanced", "weight-top", "weight-bottom"]}
    got = {r.parameters: r for r in T.tree_grid(train, test, ["a", "b", "c"], "y", grid).collect()}
    edges = T.bin_edges(train, ["a", "b", "c"])
    binned = lambda part: [([sum(v > e for e in own) for v, own in zip(r[:3], edges)], names.index(r[3])) for r in part]
    learned, judged = binned(data[:400]), binned(data[400:])
    sizes = np.array([sum(y == i for _, y in learned) for i in range(3)])
    assert len(got) == 48
    for kind in grid["impurity"]:
        for depth in grid["maxDepth"]:
            for least in grid["minSamplesSplit"]:
                for weights in grid["classWeight"]:
                    tree = grow(learned, depth, kind, least, T.class_weights_of(weights, sizes), 3)
                    pairs = Counter((y, tree(x)) for x, y in judged)
                    f1 = [2 * pairs[c, c] / (sum(n for (y, p), n in pairs.items() if y == c) + sum(n for (y, p), n in pairs.items() if p == c)) for c in {c for pair in pairs for c in pair}]
                    r = got[str({"impurity": kind, "maxDepth": depth, "minSamplesSplit": least, "classWeight": weights})]
                    assert r.accuracy == pytest.approx(sum(pairs[c, c] for c in range(3)) / 200) and r.macro_f1 == pytest.approx(sum(f1) / len(f1))


def test_odd_tables(spark):
    rows = spark.createDataFrame([(3.0, 1.0, "x"), (float("nan"), 1.0, "y"), (2.0, 1.0, "x"), (None, 1.0, "y")], "a double, b double, y string")
    got = T.tree_grid(rows, rows, ["a", "b"], "y", {"maxDepth": [1]}).first()
    assert got.accuracy == 1  # null and NaN are in the last bin
    assert T.tree_grid(rows.limit(0), rows, ["a"], "y", {}).count() == 0 and T.tree_grid(rows, rows.limit(0), ["a"], "y", {}).first().accuracy is None
    with pytest.raises(ValueError):
        T.tree_grid(rows, rows, ["a"], "y", {"depth": [1]})
    with pytest.raises(ValueError):
        T.tree_grid(rows, rows, ["a"], "y", {"classWeight": ["odd"]})
