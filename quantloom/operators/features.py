"""Scores of feature families: rank correlation and information from sorted bands of values, lasso from one pass of moments.

Rows come in blocks (``blocks``), which make their features when they are read, so no table of features is stored. Values of a
feature are moved in packed pieces, a few features at a time, and what was moved is removed before the next ones.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import brief_shuffles, forget, written
from .blocks import Read, pack, packed, record, rows_of, unpack

BANDS = 256
POINTS = 512  # values of a block that its sketch keeps
VALUES_AT_ONCE = 1 << 27  # values that are moved at a time, or those of one feature if it has more
VALUES_HELD = 1 << 21  # values that a task holds before it deals them out
SCORES = "family string, feature string, n long, rho double, mi double, mi_signed double"
WEIGHTS = "family string, feature string, n long, weight double"


def families_of(columns: Sequence[str], prefixes: Sequence[str]) -> dict[str, list[str]]:
    """The columns that begin with each prefix; prefixes without any go."""
    found = {p: [c for c in columns if c.startswith(p)] for p in prefixes}
    return {p: own for p, own in found.items() if own}


def cumulated(counts: DataFrame, by: Sequence[str], column: str, sums: Sequence[str], bands: int = BANDS) -> DataFrame:
    """``counts``, one row for each key and value of ``column``, with ``__before_{name}``: the sum of ``name`` over the key's lower values.

    The key's values are dealt over bands of about equally many values, from a quantile sketch, so outliers don't fill a band.
    """
    shares = F.array(*[F.lit(i / bands) for i in range(1, bands)])
    cuts = counts.groupBy(*by).agg(F.percentile_approx(column, shares, 10000).alias("__cuts"))
    met = counts.join(F.broadcast(cuts), list(by)) if by else counts.join(F.broadcast(cuts))
    halves = F.array(*[F.lit(1 << i) for i in reversed(range((bands - 1).bit_length()))])
    step = lambda at, half: at + F.when(F.get("__cuts", at + half - 1) < F.col(column), half).otherwise(F.lit(0))  # noqa: E731  beyond the last cut is null
    banded = met.withColumn("__band", F.aggregate(halves, F.lit(0), step)).drop("__cuts")
    totals = banded.groupBy(*by, "__band").agg(*[F.sum(c).alias(f"__s_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "__band", *[F.coalesce(F.sum(f"__s_{c}").over(earlier), F.lit(0)).alias(f"__start_{c}") for c in sums])
    inside = Window.partitionBy(*by, "__band").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    out = banded.join(F.broadcast(starts), [*by, "__band"])
    out = out.withColumns({f"__before_{c}": F.col(f"__start_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return out.drop("__band", *[f"__start_{c}" for c in sums])


def _masks(columns: Mapping[str, np.ndarray], families: Sequence[Sequence[str]], target: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows with a finite target, and for each family those where all of its columns are finite too."""
    there = np.isfinite(columns[target])
    return there, [np.logical_and.reduce([there, *[np.isfinite(columns[c]) for c in own]]) for own in families]


def _joined(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, centred products) of parts with the same, added up."""
    n, mean, square = parts[0]
    for m, other, more in parts[1:]:
        apart, n = other - mean, n + m
        square = square + more + np.outer(apart, apart) * ((n - m) * m / n)
        mean = mean + apart * (m / n)
    return n, mean, square


def _cut(parts: Sequence[tuple[np.ndarray, float]], bands: int) -> np.ndarray:
    """Values that cut all the sketches' values into ``bands`` of about as many."""
    values, weights = np.concatenate([v for v, _ in parts]), np.concatenate([np.full(len(v), w) for v, w in parts])
    order = np.argsort(values, kind="stable")
    upto = weights[order].cumsum()
    return np.unique(values[order][np.searchsorted(upto, upto[-1] * np.arange(1, bands) / bands).clip(0, len(order) - 1)])


MOMENTS, TARGET, SKETCH = range(3)


def _measured(blocks: DataFrame, read: Read, families: Sequence[Sequence[str]], target: str, pairs: Sequence[tuple[int, str]] = (), bands: int = BANDS, moments: bool = False) -> dict[tuple[int, int], tuple]:
    """From one pass: each family's (rows, means, centred products) of target and columns, the last two with ``moments`` only, under (MOMENTS, family);
    cuts of the values of each pair of a family and a column under (SKETCH, pair), and of the target under (TARGET, 0)."""
    names = list(dict.fromkeys([target, *[c for own in families for c in own]]))
    schema = pa.schema([("kind", pa.int32()), ("k", pa.int32()), ("data", pa.binary())])

    def sketch(x: np.ndarray) -> tuple[np.ndarray, float]:
        kept = min(POINTS, len(x))
        return np.sort(x)[(np.arange(kept) * 2 + 1) * len(x) // (2 * kept)], len(x) / kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple] = {}
        for row in rows_of(batches):
            columns, out = read(row, names), []
            there, masks = _masks(columns, families, target)
            for i, (own, mask) in enumerate(zip(families, masks)):
                if mask.any():
                    z = np.column_stack([columns[c][mask] for c in [target, *own]]) if moments else np.zeros((mask.sum(), 0))
                    mean = z.mean(axis=0)
                    part = int(mask.sum()), mean, (z - mean).T @ (z - mean)
                    sums[i] = _joined([sums[i], part]) if i in sums else part
            if pairs and there.any():
                out = [(SKETCH, k, pickle.dumps(sketch(columns[c][masks[i]]))) for k, (i, c) in enumerate(pairs) if masks[i].any()]
                out.append((TARGET, 0, pickle.dumps(sketch(columns[target][there]))))
            yield record(out, schema)
        yield record([(MOMENTS, i, pickle.dumps(x)) for i, x in sums.items()], schema)

    def merge(group: pa.Table) -> pa.Table:
        kind, parts = group["kind"][0].as_py(), [pickle.loads(x) for x in group["data"].to_pylist()]
        if kind == MOMENTS:
            found = _joined(parts)
        else:
            found = _cut(parts, bands), int(round(sum(len(v) * w for v, w in parts)))
        return pa.Table.from_batches([record([(kind, group["k"][0].as_py(), pickle.dumps(found))], schema)])

    with brief_shuffles(blocks.sparkSession):
        rows = blocks.mapInArrow(run, "kind int, k int, data binary").groupBy("kind", "k").applyInArrow(merge, "kind int, k int, data binary").collect()  # a row a family and a pair
    return {(r.kind, r.k): pickle.loads(r.data) for r in rows}


def _edges(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, [len(sorted_)]]) if len(sorted_) else np.zeros(1, int)


def _blocks_with_ranks(blocks: DataFrame, read: Read, target: str, groups: Sequence[Sequence[str]], cuts: np.ndarray) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``blocks`` with ``ranks``: for each band of the target, the doubled mean ranks within the band of the block's distinct values, and each band's
    start, for every group: the rows on which its columns are finite.

    A block asks for its distinct values once, so neither a frequent value nor a row is moved on its own.
    """
    names, schema = list(dict.fromkeys([target, *[c for own in groups for c in own]])), pa.schema([("band", pa.int32()), ("block", pa.int64()), ("m", pa.int64()), ("values", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            columns = read(row, names)
            there, masks = _masks(columns, groups, target)
            own, place = np.unique(columns[target][there] + 0.0, return_inverse=True)  # -0.0 is 0.0
            counts = np.stack([np.bincount(place[mask[there]], minlength=len(own)) for mask in masks])
            band = np.searchsorted(cuts, own)
            at = _edges(band)
            yield record([(int(band[a]), row["block"], int(b - a), pack(own[a:b]), pack(counts[:, a:b].ravel())) for a, b in zip(at, at[1:])], schema)

    replies = pa.schema([("block", pa.int64()), ("band", pa.int32()), ("m", pa.int64()), ("ranks", pa.binary()), ("totals", pa.list_(pa.int64()))])

    def answer(asked: pa.Table) -> pa.Table:
        band, rows = asked["band"][0].as_py(), asked.select(["block", "m", "values", "counts"]).to_pylist()
        own, place = np.unique(np.concatenate([unpack(r["values"], r["m"]) for r in rows]), return_inverse=True)
        counts = np.concatenate([unpack(r["counts"], r["m"] * len(groups), np.int64).reshape(len(groups), -1) for r in rows], axis=1)
        n = np.zeros((len(groups), len(own)), np.int64)
        for g in range(len(groups)):
            np.add.at(n[g], place, counts[g])
        doubled = 2 * n.cumsum(axis=1) - n + 1  # twice the rows before, and n + 1: a doubled mean rank is a whole number
        ends = np.cumsum([r["m"] for r in rows])
        out = [(r["block"], band, r["m"], pack(doubled[:, place[e - r["m"] : e]].ravel()), n.sum(axis=1).tolist()) for r, e in zip(rows, ends)]
        return pa.Table.from_batches([record(out, replies)])

    asked = blocks.mapInArrow(ask, "band int, block long, m long, values binary, counts binary")
    answers = asked.groupBy("band").applyInArrow(answer, "block long, band int, m long, ranks binary, totals array<long>")
    own = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("band", "m", "ranks", "totals"))).alias("ranks"))
    with brief_shuffles(blocks.sparkSession):
        met = written(blocks.join(own.hint("merge"), "block", "left"), "counts")
        totals = met.select(F.explode("ranks").alias("r")).groupBy("r.band").agg(F.first("r.totals").alias("t")).orderBy("band").collect()  # a row a band
    before, starts = np.zeros(len(groups), np.int64), {}
    for r in totals:
        starts[r.band], before = before, before + np.array(r.t)
    return met, starts


def _scored(ranked: DataFrame, starts: Mapping[int, np.ndarray], read: Read, families: Sequence[Sequence[str]], target: str, group_of: Mapping[int, int], partial: Sequence[int], pairs: Mapping[int, tuple[int, str]], sizes: Mapping[int, int], cuts: Mapping[int, np.ndarray], bins: int) -> list:
    """For some pairs, numbered, rows (k, b, xx, xy, yy, b0, b1...): the sums of each bin of ranks.

    A task adds up rows with the same value and bin of the target, and deals them over bands of the value; a band is sorted alone, and
    its ranks begin where those of the bands before end.
    """
    masked = sorted({i for i, _ in pairs.values() if i in partial})
    names = list(dict.fromkeys([target, *[c for _, c in pairs.values()], *[c for i in masked for c in families[i]]]))
    schema = pa.schema([("k", pa.int32()), ("band", pa.int32()), ("m", pa.int64()), ("n", pa.int64()), ("x", pa.binary()), ("ns", pa.binary()), ("s", pa.binary()), ("yy", pa.float64())])
    fields = "k int, band int, m long, n long, x binary, ns binary, s binary, yy double"
    n_groups = 1 + len(partial)

    def of_bin(s: np.ndarray, n: np.ndarray | int, total: int) -> np.ndarray:  # of the mean of n doubled ranks that add up to s
        return (s - n) * bins // (2 * total * n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {k: [] for k in pairs}

        def flush() -> Iterator[pa.RecordBatch]:
            for k, parts in held.items():
                if not parts:
                    continue
                total = sizes[pairs[k][0]]
                x, s = (np.concatenate(c) for c in zip(*parts))
                parts.clear()
                yy = float(((s - total - 1).astype(float) ** 2).sum())
                order = np.argsort(x, kind="stable")
                x, s, n = x[order], s[order], np.ones(len(x), np.int64)
                if (x[1:] == x[:-1]).any():
                    order = np.lexsort((s, x))
                    x, s = x[order], s[order]
                    b = of_bin(s, 1, total)
                    at = np.concatenate([[0], np.flatnonzero((x[1:] != x[:-1]) | (b[1:] != b[:-1])) + 1])
                    x, s, n = x[at], np.add.reduceat(s, at), np.diff(at, append=len(x))
                band = np.searchsorted(cuts[k], x)
                at = _edges(band)
                yield record([(k, int(band[i]), int(j - i), int(n[i:j].sum()), pack(x[i:j]), pack(n[i:j]) if (n[i:j] != 1).any() else None, pack(s[i:j]), yy if i == 0 else 0.0) for i, j in zip(at, at[1:])], schema)

        size = 0
        for row in rows_of(batches):
            if not row["ranks"]:
                continue
            columns = read(row, names)
            there, masks = _masks(columns, [families[i] for i in masked], target)
            _, place = np.unique(columns[target][there] + 0.0, return_inverse=True)
            ranks = np.concatenate([unpack(r["ranks"], r["m"] * n_groups, np.int64).reshape(n_groups, -1) + 2 * starts[r["band"]][:, None] for r in row["ranks"]], axis=1)[:, place]
            for k, (i, c) in pairs.items():
                mask = masks[masked.index(i)] if i in masked else there
                if mask.any():
                    held[k].append((columns[c][mask] + 0.0, ranks[group_of[i], mask[there]]))
                    size += int(mask.sum())
            if size >= VALUES_HELD:
                yield from flush()
                size = 0
        yield from flush()

    def sort(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        x, s = (np.concatenate([unpack(r[c], r["m"], kind) for r in rows]) for c, kind in (("x", np.float64), ("s", np.int64)))
        n = np.concatenate([np.ones(r["m"], np.int64) if r["ns"] is None else unpack(r["ns"], r["m"], np.int64) for r in rows])
        order = np.argsort(x, kind="stable")
        x, s, n = x[order], s[order], n[order]
        at = _edges(x)
        own = np.add.reduceat(n, at[:-1])
        doubled = np.repeat(2 * own.cumsum() - own + 1, np.diff(at))  # within the band
        out = (rows[0]["k"], rows[0]["band"], len(x), int(n.sum()), pack(np.diff(doubled, prepend=0)), pack(n) if (n != 1).any() else None, pack(s), sum(r["yy"] for r in rows))
        return pa.Table.from_batches([record([out], schema)])

    summed = pa.schema([("k", pa.int32()), ("b", pa.int32()), *[(c, pa.float64()) for c in ("xx", "xy", "yy")], *[(f"b{b}", pa.int64()) for b in range(bins)]])

    with brief_shuffles(ranked.sparkSession):
        values = written(ranked.mapInArrow(deal, fields).groupBy("k", "band").applyInArrow(sort, fields), "values")
        before: dict[tuple[int, int], int] = {}
        last: dict[int, int] = {}
        for r in values.select("k", "band", "n").orderBy("k", "band").collect():  # a row a pair and band
            before[r.k, r.band], last[r.k] = last.get(r.k, 0), last.get(r.k, 0) + r.n

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list] = {}
            for r in rows_of(batches):
                total, s = sizes[pairs[r["k"]][0]], unpack(r["s"], r["m"], np.int64)
                n = np.ones(len(s), np.int64) if r["ns"] is None else unpack(r["ns"], r["m"], np.int64)
                doubled = unpack(r["x"], r["m"], np.int64).cumsum() + 2 * before[r["k"], r["band"]]
                rx, bx = (doubled - total - 1).astype(float), of_bin(doubled, 1, total)
                sums = np.stack([np.bincount(bx, w, bins) for w in (rx * rx * n, rx * (s - n * (total + 1)))])
                joint = np.bincount(bx * bins + of_bin(s, n, total), n, bins * bins).astype(np.int64).reshape(bins, bins)
                own = found.setdefault(r["k"], [np.zeros((2, bins)), np.zeros((bins, bins), np.int64), 0.0])
                found[r["k"]] = [own[0] + sums, own[1] + joint, own[2] + r["yy"]]
            yield record([(k, b, *sums[:, b].tolist(), yy if b == 0 else 0.0, *joint[b].tolist()) for k, (sums, joint, yy) in found.items() for b in range(bins)], summed)

        sums = values.mapInArrow(add, "k int, b int, xx double, xy double, yy double, " + ", ".join(f"b{b} long" for b in range(bins)))
        rows = sums.groupBy("k", "b").agg(*[F.sum(c).alias(c) for c in sums.columns[2:]]).collect()
    forget(values)
    return rows


def block_scores(blocks: DataFrame, read: Read, families: Mapping[str, Sequence[str]], target: str, bins: int = 16, bands: int = BANDS, alpha: float | None = None, whole: str | None = None) -> tuple[list[tuple], list[tuple]]:
    """Rows of SCORES of the families and, with ``alpha``, of WEIGHTS, also of all columns together under the name ``whole``; see ``family_scores``.

    Blocks are read once for sizes, moments and cuts, and once for the ranks of the target; they are written with these and deleted. Then features are taken in turn, so the disk
    holds the values of a few at a time, however many there are. No more than a row a pair of feature and band comes to the driver.
    """
    every = dict(families)
    if alpha is not None and whole is not None:
        every[whole] = list(dict.fromkeys(c for own in families.values() for c in own))
    own, pairs = list(every.values()), [(i, c) for i, fs in enumerate(families.values()) for c in fs]
    found = _measured(blocks, read, own, target, pairs, bands, alpha is not None)
    sizes = {i: found[MOMENTS, i][0] if (MOMENTS, i) in found else 0 for i in range(len(own))}
    weights = [] if alpha is None else [w for i, name in enumerate(every) for w in _fitted(name, own[i], found.get((MOMENTS, i)), alpha)]

    rows: dict[int, list] = {}
    if any(sizes[i] for i, _ in pairs):
        partial = [i for i in range(len(families)) if 0 < sizes[i] < found[TARGET, 0][1]]  # the other families hold on all rows or on none
        ranked, starts = _blocks_with_ranks(blocks, read, target, [(), *[own[i] for i in partial]], found[TARGET, 0][0])
        forget(blocks)
        group_of = {i: 1 + partial.index(i) if i in partial else 0 for i in range(len(families))}
        left = [k for k, (i, _) in enumerate(pairs) if sizes[i]]
        while left:
            some = [left.pop(0)]
            while left and sum(sizes[pairs[k][0]] for k in [*some, left[0]]) <= VALUES_AT_ONCE:
                some.append(left.pop(0))
            for r in _scored(ranked, starts, read, own, target, group_of, partial, {k: pairs[k] for k in some}, sizes, {k: found[SKETCH, k][0] for k in some}, bins):
                rows.setdefault(r.k, []).append(r)
        forget(ranked)
    else:
        forget(blocks)
    names = list(families)
    return [_score(names[i], c, sorted(rows.get(k, ()), key=lambda r: r.b), bins) for k, (i, c) in enumerate(pairs)], weights


def _score(family: str, feature: str, own: list, bins: int) -> tuple:
    """A row of SCORES from the sums of each bin."""
    if not own:
        return family, feature, 0, None, None, None
    xx, xy, yy = (sum(r[c] for r in own) for c in ("xx", "xy", "yy"))
    rho = xy / (xx * yy) ** 0.5 if xx > 0 and yy > 0 else None
    joint = np.array([[r[f"b{b}"] for b in range(bins)] for r in own], float)
    n, there = joint.sum(), joint > 0
    even = np.outer(joint.sum(axis=1), joint.sum(axis=0))
    mi = float((joint[there] / n * np.log(joint[there] * n / even[there])).sum())
    return family, feature, int(n), rho, mi, mi * float(np.sign(rho or 0))


def _fitted(family: str, columns: Sequence[str], moments: tuple | None, alpha: float) -> list[tuple]:
    """Rows of WEIGHTS from a family's moments."""
    if moments is None:
        return [(family, c, 0, None) for c in columns]
    n, _, square = moments
    return [(family, c, n, float(w)) for c, w in zip(columns, coordinate_descent(square[1:, 1:] / n, square[0, 1:] / n, alpha))]


def _stored(df: DataFrame, families: Mapping[str, Sequence[str]], target: str) -> tuple[DataFrame, Read]:
    """The columns in blocks, written once."""
    names = dict.fromkeys([target, *[c for own in families.values() for c in own]])
    blocks, read = packed(df, {c: F.col(c) for c in names})
    return written(blocks, "features"), read


def rank_scores(df: DataFrame, families: Mapping[str, Sequence[str]], target: str, bins: int = 16, bands: int = BANDS) -> DataFrame:
    """(family, feature, n, rho, mi, mi_signed): Spearman's correlation with the target, and mutual information in nats.

    A family counts the rows on which the target and all its columns are finite. Equal values share their mean rank;
    information is that of ``bins`` bins of ranks on either side, so equal values share a bin, and ``mi_signed`` takes the sign of
    rho. rho is null, and mi 0, where a side has one value; without rows both are null.

    The target is ranked once for all families. A frequent value is a few rows, and no feature's rows meet in one task.
    """
    blocks, read = _stored(df, families, target)
    scores, _ = block_scores(blocks, read, families, target, bins, bands)
    return df.sparkSession.createDataFrame(scores, SCORES)


def coordinate_descent(gram: np.ndarray, cross: np.ndarray, alpha: float, tolerance: float = 1e-10, sweeps: int = 20000) -> np.ndarray:
    """The weights w that make w'Gw / 2 - c'w + alpha * |w| least. Sweeps end when no weight moves a fit by over ``tolerance`` of the largest |c|."""
    w, scale, own = np.zeros(len(cross)), np.sqrt(np.maximum(np.diag(gram), 0)), np.diag(gram)
    open_ = np.flatnonzero(own > 1e-12 * max(own.max(initial=0.0), 1e-300))
    least, fitted = tolerance * max(np.abs(cross).max(initial=0.0), 1e-300), np.zeros(len(cross))
    for _ in range(sweeps):
        moved = 0.0
        for j in open_:
            rest = cross[j] - fitted[j] + own[j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / own[j]
            if new != w[j]:
                fitted += gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * scale[j] * scale[open_].max())
                w[j] = new
        if moved <= least:
            break
    return w


def lasso_families(df: DataFrame, families: Mapping[str, Sequence[str]], target: str, alpha: float = 1.0) -> DataFrame:
    """(family, feature, n, weight): for each family a lasso fit with an intercept, which makes |y - Xw|^2 / 2n + alpha * |w| least.

    A family counts the rows on which the target and all its columns are finite. A feature without spread weighs 0;
    without rows weights are null. One pass takes every family's centred products, a matrix a task; the driver holds (features of the family)^2 sums
    and fits them, whatever the number of rows.
    """
    blocks, read = packed(df, {c: F.col(c) for c in dict.fromkeys([target, *[c for own in families.values() for c in own]])})
    found = _measured(blocks, read, list(families.values()), target, moments=True)
    return df.sparkSession.createDataFrame([w for i, (name, own) in enumerate(families.items()) for w in _fitted(name, own, found.get((MOMENTS, i)), alpha)], WEIGHTS)


def family_scores(df: DataFrame, families: Mapping[str, Sequence[str]], target: str, alpha: float = 1.0, whole: str | None = "all") -> DataFrame:
    """(family, feature, n, weight, rho, mi, mi_signed) for every family, and lasso weights of all features together under the name ``whole``."""
    blocks, read = _stored(df, families, target)
    return family_scores_of(blocks, read, families, target, alpha, whole)


def family_scores_of(blocks: DataFrame, read: Read, families: Mapping[str, Sequence[str]], target: str, alpha: float = 1.0, whole: str | None = "all") -> DataFrame:
    """``family_scores`` of stored blocks, which are deleted."""
    scores, weights = block_scores(blocks, read, families, target, alpha=alpha, whole=whole)
    spark = blocks.sparkSession
    return spark.createDataFrame(weights, WEIGHTS).join(spark.createDataFrame(scores, SCORES).drop("n"), ["family", "feature"], "left")
