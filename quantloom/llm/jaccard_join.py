"""Exact n-gram Jaccard join with set-relation skipping.

Each distinct set of word shingles is a node. Its shingles are put in one global order, rarest first,
and only a prefix goes to the inverted lists: two sets with a Jaccard similarity of at least the
threshold share a shingle of their prefixes. Then

* index level: a list is sorted by size and cut into blocks that know the range of their sizes and positions;
  a pair of blocks that cannot reach the needed overlap, by size or position, is skipped whole;
* answer level: the first set of each list is compared with the others first. A set that proves highly
  similar to such a leader takes its answers over from the leader's: the leader's overlaps bound those
  of the follower, and only pairs that the bounds leave open are compared.

Order statistics come from a count sketch of fixed size over all documents; it decides the order only,
never which pairs are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, forget, fresh_name, heavy_keys, join_by_key, partitions, saved
from .wordcodes import SHINGLE_WORDS, row_shingles, set_code, text_blocks, words_of

SKETCH_BITS = 18
BLOOM_BITS = 25
BLOCK_SETS = 128


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, data, bounds in text_blocks(batch.column("text")):
        for i, shingles in enumerate(row_shingles(words_of(data, bounds), width)):
            yield row + i, shingles


def signature(shingles: np.ndarray) -> bytes:
    """The parity of a set's members in each of 2**k cells, at least as many as members; folding halves gives fewer cells."""
    cells = 1 << max(8, int(len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def cells_apart(a: bytes, b: bytes) -> int:
    """In how many cells two signatures differ; never more than the sets' symmetric difference."""
    x, y = (np.frombuffer(z, np.uint64) for z in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


_MEMBERS = "doc_id long, node long, n long, signature binary, part int, counts binary"


def _members(width: int):
    """Rows (doc_id, node, n, signature) of a task's documents, the signature where a set is met first, and then
    its part of the count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << SKETCH_BITS, np.int64), set()

        def add(fresh):
            np.add(counts, np.bincount((np.concatenate(fresh) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)), out=counts)

        names = [c.split()[0] for c in _MEMBERS.split(", ")]
        for batch in batches:
            nodes, sizes = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            signatures: list[bytes | None] = [None] * batch.num_rows
            fresh, waiting = [], 0
            for row, shingles in _sets(batch, width):
                sizes[row] = len(shingles)
                nodes[row] = node = set_code(shingles) if len(shingles) else 0
                if len(shingles) and node not in seen:
                    seen.add(node)
                    signatures[row] = signature(shingles)
                    fresh.append(shingles)
                    waiting += len(shingles)
                if waiting > 1 << 18:
                    add(fresh)
                    fresh, waiting = [], 0
            if fresh:
                add(fresh)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(nodes), pa.array(sizes), pa.array(signatures, pa.binary()), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())],
                names,
            )
        if seen:
            blank = pa.nulls(64, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [blank, blank, blank, pa.nulls(64, pa.binary()), pa.array(np.arange(64, dtype=np.int32)), pa.array([p.tobytes() for p in counts.reshape(64, -1)], pa.binary())],
                names,
            )

    return run


def _add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            own = np.frombuffer(counts.as_py(), np.int64)
            total[part] = total[part] + own if part in total else own
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["part", "counts"])


def _rarity(sketch: DataFrame) -> np.ndarray:
    """For each sketch cell a class of frequency; 64 rows and one byte a cell, whatever the input."""
    counts = np.zeros((64, (1 << SKETCH_BITS) // 64), np.int64)
    for row in sketch.repartition(64, "part").mapInArrow(_add_sketches, "part int, counts binary").collect():
        counts[row["part"]] += np.frombuffer(row["counts"], np.int64)
    flat = np.maximum(counts.reshape(-1), 1)
    return np.clip(np.ceil(4 * np.log2(flat / max(1.0, counts.mean()))), 0, 255).astype(np.uint8)


def _postings(width: int, rarity, num: int, den: int):
    """Rows (code, node, place) for the prefix of each distinct set of a task; place is size * 2**32 + position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = rarity.value, set()
        for batch in batches:
            codes, nodes, sizes, lengths = [], [], [], []
            for _, shingles in _sets(batch, width):
                n = len(shingles)
                node = set_code(shingles) if n else 0
                if not n or node in seen:
                    continue
                seen.add(node)
                keep = n + num * n // -den + 1
                order = (classes[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))
                codes.append(shingles[np.argsort(order, kind="stable")[:keep]])
                nodes.append(node)
                sizes.append(n)
                lengths.append(keep)
            if nodes:
                lengths = np.array(lengths)
                place = np.repeat(np.array(sizes, np.int64) << 32, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(codes).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), lengths)), pa.array(place)], ["code", "node", "place"])

    return run


def _whole_lists(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by code, cut so that no list is cut."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
        if not len(new[0]):
            continue
        last = int(np.searchsorted(new[0], new[0][-1], "left"))
        if last or (held and held[-1][0][-1] != new[0][-1]):  # here ends a list
            yield [np.concatenate(x) for x in zip(*held, [c[:last] for c in new])]
            held, new = [], [c[last:] for c in new]
        held.append(new)
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by code, the entries of lists with two different sets or more."""
    for code, node, place in _whole_lists(batches, 3):
        order = np.lexsort((node, code))
        code, node, place = code[order], node[order], place[order]
        first = np.concatenate(([True], (code[1:] != code[:-1]) | (node[1:] != node[:-1])))
        code, node, place = code[first], node[first], place[first]
        same = code[1:] == code[:-1]
        keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (code, node, place)], ["code", "node", "place"])


def _lists(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """Whole lists, one after another, from rows sorted by code."""
    for columns in _whole_lists(batches, width):
        cuts = np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(columns[0])]):
            yield [x[a:b] for x in columns]


def _needed(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least intersection of sets of sizes n and m that link."""
    return -((num * (n + m)) // -(num + den))


def _meet_first(n, p, m, q, num: int, den: int):
    """Whether sets of sizes n <= m that link may meet at positions p and q for the first time."""
    return (den * n >= num * m) & (np.minimum(n - p, m - q) >= _needed(n, m, num, den))


def _pair_batches(pairs: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for x in pairs:
        held.append(x)
        rows += len(x[0])
        if rows > 1 << 16:
            yield _distinct(held, names)
            held, rows = [], 0
    if held:
        yield _distinct(held, names)


def _distinct(held, names):
    a, b, n_a, n_b = (np.concatenate(x) for x in zip(*held))
    turn = (n_a == n_b) & (a > b)  # one way round in all lists; a is no larger than b already
    table = np.unique(np.stack([np.where(turn, b, a), np.where(turn, a, b), n_a, n_b], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(names))], names)


def _leader_pairs(num: int, den: int):
    """In each list, pairs of a leader with the sets that its size admits; of the others, the next leader.
    Leaders are the sets that share the largest part of their shingles."""

    def pairs(batches):
        for _, node, place, rank in _lists(batches, 4):
            size, position = place >> 32, place & 0xFFFFFFFF
            left = np.lexsort((node, -rank))
            while len(left) > 1:
                a, b = left[0], left[1:]
                fits = (den * size[a] >= num * size[b]) & (den * size[b] >= num * size[a])
                left, b = b[~fits], b[fits]
                lo, hi = np.where(size[b] < size[a], b, a), np.where(size[b] < size[a], a, b)
                keep = _meet_first(size[lo], position[lo], size[hi], position[hi], num, den)
                if keep.any():
                    yield node[lo[keep]], node[hi[keep]], size[lo[keep]], size[hi[keep]]

    return lambda batches: _pair_batches(pairs(batches), ["a", "b", "n_a", "n_b"])


def _block_pairs(num: int, den: int):
    """Pairs of different components that a list leaves open, block by block."""

    def pairs(batches):
        for _, node, place, root in _lists(batches, 4):
            if (root == root[0]).all():
                continue
            size, position = place >> 32, place & 0xFFFFFFFF
            starts = np.arange(0, len(node), BLOCK_SETS)
            least, most = size[starts], size[np.minimum(starts + BLOCK_SETS, len(node)) - 1]
            left = np.maximum.reduceat(size - position, starts)
            for i, a in enumerate(starts):
                rows = slice(a, a + BLOCK_SETS)
                # blocks j >= i hold sets as large or larger: by size, and by what is left behind the position
                ahead = np.arange(i, len(starts))
                ahead = ahead[(den * most[i] >= num * least[ahead]) & (np.minimum(left[i], left[ahead]) >= _needed(least[i], least[ahead], num, den))]
                for j in ahead:
                    cols = slice(starts[j], starts[j] + BLOCK_SETS)
                    ok = _meet_first(size[rows, None], position[rows, None], size[None, cols], position[None, cols], num, den) & (root[rows, None] != root[None, cols])
                    x, y = np.nonzero(np.triu(ok, 1) if i == j else ok)
                    if len(x):
                        yield node[rows][x], node[cols][y], size[rows][x], size[cols][y]

    return lambda batches: _pair_batches(pairs(batches), ["a", "b", "n_a", "n_b"])


def _bloom(nodes: DataFrame) -> np.ndarray:
    """A filter of 2**BLOOM_BITS bits over nodes; at most 2**(BLOOM_BITS - 6) rows reach the driver."""
    mask = (1 << BLOOM_BITS) - 1
    bit = F.explode(F.array(F.col("node").bitwiseAND(mask), F.shiftrightunsigned("node", 32).bitwiseAND(mask)))
    words = nodes.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    got = words.toPandas()
    table[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def _wanted_sets(width: int, bloom):
    mask = (1 << BLOOM_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = bloom.value, set()

        def known(bit: int) -> bool:
            return bool(int(bits[bit >> 6]) >> (bit & 63) & 1)

        for batch in batches:
            nodes, sets, held = [], [], 0
            for _, shingles in _sets(batch, width):
                node = set_code(shingles) if len(shingles) else 0
                if not len(shingles) or node in seen or not (known(node & mask) and known((node >> 32) & mask)):
                    continue
                seen.add(node)
                nodes.append(node)
                sets.append(shingles.view(np.int64))
                held += len(shingles)
                if held > 1 << 19:
                    yield _set_batch(nodes, sets)
                    nodes, sets, held = [], [], 0
            if nodes:
                yield _set_batch(nodes, sets)

    return run


def _set_batch(nodes, sets):
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], ["node", "shingles"])


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        apart = np.array([cells_apart(x, y) for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist())], np.int64)
        n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        most = np.minimum(np.minimum(n_a, n_b), (n_a + n_b - apart) // 2)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(most)], ["a", "b", "n_a", "n_b", "most"])


def _meet(pairs: DataFrame, of_node: DataFrame, value: str) -> DataFrame:
    """``pairs(a, b, n_a, n_b)`` with ``of_a`` and ``of_b``, the ``value`` of each side in ``of_node(node, value)``.

    A node with many pairs is dealt over salts, so many as its share of the pairs asks for; such nodes are
    few (``heavy_keys``), and only theirs is repeated.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("rows_"))
    heavy = saved(heavy_keys(ends, "node", share=True), "heavy")
    for side, other in (("a", "b"), ("b", "a")):
        salts = heavy.select(F.col("node").alias(side), "share_")
        pairs = pairs.join(F.broadcast(salts), side, "left").withColumn("salt_", F.pmod(F.xxhash64(other), F.coalesce("share_", F.lit(1)))).drop("share_")
        dealt = of_node.join(F.broadcast(heavy), "node", "left").select(F.col("node").alias(side), F.col(value).alias(f"of_{side}"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("share_", F.lit(1)) - 1)).alias("salt_"))
        pairs = pairs.join(dealt, [side, "salt_"]).drop("salt_")
    return pairs


def _bounded(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """``pairs`` with ``most``, an upper bound of the intersection by the sets' signatures."""
    return _meet(pairs, signatures, "signature").mapInArrow(_bounds, "a long, b long, n_a long, n_b long, most long")


def _overlaps(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``pairs`` with ``both``, the size of the exact intersection, for every pair."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    bloom = pairs.sparkSession.sparkContext.broadcast(_bloom(nodes))
    sets = texts.mapInArrow(_wanted_sets(width, bloom), "node long, shingles array<long>")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
    return _meet(pairs, sets, "shingles").select("a", "b", "n_a", "n_b", F.size(F.array_intersect("of_a", "of_b")).cast("long").alias("both"))


def _may_link(overlap: str, num: int, den: int) -> str:
    return f"{num + den} * {overlap} >= {num} * (n_a + n_b)"


def _links(overlaps: DataFrame, num: int, den: int) -> DataFrame:
    return overlaps.where(_may_link("both", num, den))


def ngram_jaccard_join(docs: DataFrame, width: int = SHINGLE_WORDS, num: int = 75, den: int = 100) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id.

    Documents link when ``den * |A & B| >= num * |A | B|`` for their sets of distinct ``width``-word
    shingles (of the whole word sequence, if shorter); component_id is the least doc_id reachable.

    Null and empty texts, and texts of white space, have no shingles and link with nothing. Equal texts
    and repeated rows have one set and so one component. A row without doc_id takes part; its
    component_id is the least id of its component, null if it has none. Other columns are ignored. An
    empty table gives no rows.
    """
    texts, spark = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), docs.sparkSession
    n_parts = partitions(spark)
    first = saved(texts.mapInArrow(_members(width), _MEMBERS), "members")
    members = first.where("part is null").select("doc_id", "node", "n")
    signatures = first.where("signature is not null").groupBy("node").agg(F.first("signature").alias("signature"))
    rarity = spark.sparkContext.broadcast(_rarity(first.where("part is not null").select("part", "counts")))
    postings = texts.mapInArrow(_postings(width, rarity, num, den), "code long, node long, place long")
    lists = saved(postings.repartition(n_parts, "code").sortWithinPartitions("code").mapInArrow(_shared_lists, "code long, node long, place long"), "lists")
    # answers of leaders
    kind = "a long, b long, n_a long, n_b long"
    rank = F.count(F.lit(1)).over(Window.partitionBy("node")) / F.shiftright("place", 32)  # as many rows a node as its prefix is long
    ranked = lists.withColumn("rank", rank).repartition(n_parts, "code").sortWithinPartitions("code")
    stars = saved(ranked.mapInArrow(_leader_pairs(num, den), kind).distinct(), "stars")
    bounded = saved(_bounded(stars, signatures), "bounded")
    compared = saved(_overlaps(bounded.where(_may_link("most", num, den)).drop("most"), texts, width), "compared")
    answers = compared.withColumn("most", F.col("both")).unionByName(bounded.where(f"not ({_may_link('most', num, den)})"), allowMissingColumns=True)
    roots = saved(components(_links(compared, num, den)), "roots")
    # what the lists leave open between different components
    rooted = lists.join(roots.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left").select("code", "node", "place", F.coalesce("root", "node").alias("root"))
    rest = rooted.repartition(n_parts, "code").sortWithinPartitions("code", "place", "node").mapInArrow(_block_pairs(num, den), kind)
    rest = saved(rest.distinct().join(stars.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    decided = saved(_derived(rest, answers, num, den), "decided")
    still = saved(_bounded(decided.where("state = 0").select("a", "b", "n_a", "n_b"), signatures).where(_may_link("most", num, den)).drop("most"), "still")
    found = saved(_links(_overlaps(still, texts, width), num, den).select("a", "b").union(decided.where("state = 1").select("a", "b")), "links")
    # components of components
    root_of = roots.withColumnRenamed("node", "node_")
    lifted = found
    for side in ("a", "b"):
        lifted = lifted.join(root_of, F.col(side) == F.col("node_"), "left").withColumn(side, F.coalesce("root", side)).drop("node_", "root")
    above = saved(components(lifted), "above").select(F.col("node").alias("root"), F.col("root").alias("top"))
    tops = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("top"))
    tops = tops.union(above.join(roots, above["root"] == roots["node"], "left_anti").select(F.col("root").alias("node"), "top"))
    # least ids: of a set's copies, then of a component's sets; a set or component with many rows is joined apart
    nodes = saved(members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("rows_")).join(tops, "node", "left"), "nodes")
    tops = saved(nodes.where("top is not null").groupBy("top").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("rows_")), "tops")
    linked = join_by_key(nodes.where("top is not null"), tops, "top").unionByName(nodes.where("top is null"), allowMissingColumns=True)
    named = saved(linked.select("node", F.coalesce("least", "own").alias("component_id"), "rows_"), "named")
    forget(lists, stars, bounded, compared, roots, rest, decided, still, found, above, nodes, tops)
    out = join_by_key(members.where("n > 0"), named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(members.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))


def _derived(rest: DataFrame, answers: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs with ``state``: 1 linked, -1 not linked, both by the bounds of a leader's answers; 0 open.

    For a leader L of b that was compared with a: ``|a & L| - |L - b| <= |a & b| <= |a & L| + |b - L|``.
    Where only a bound of ``|a & L|`` is known (``most``, ``both`` being null), the upper one holds still.
    """
    near = _links(answers, num, den)
    leader = near.groupBy("b").agg(F.max_by(F.struct("a", "n_a", "both"), F.struct("both", "a")).alias("l")).select(F.col("b").alias("f"), F.col("l.a").alias("l"), F.col("l.n_a").alias("n_leader"), F.col("l.both").alias("with_leader"))
    leader = saved(leader, "leaders")
    known = answers.select(F.col("a").alias("k1"), F.col("b").alias("k2"), F.col("both").alias("seen"), "most")
    known = known.union(known.select("k2", "k1", "seen", "most"))
    out = rest
    for side, other in (("a", "b"), ("b", "a")):
        out = out.join(leader, F.col(side) == F.col("f"), "left").join(known, (F.col("l") == F.col("k1")) & (F.col(other) == F.col("k2")), "left")
        out = out.withColumn(f"up_{side}", F.col("most") + F.col(f"n_{side}") - F.col("with_leader"))
        out = out.withColumn(f"low_{side}", F.col("seen") - F.col("n_leader") + F.col("with_leader")).drop("f", "l", "n_leader", "with_leader", "k1", "k2", "seen", "most")
    need = F.expr(f"{num} * (n_a + n_b)")
    low, up = F.greatest("low_a", "low_b"), F.least("up_a", "up_b")
    state = F.when((num + den) * low >= need, 1).when((num + den) * up < need, -1).otherwise(0)
    return out.select("a", "b", "n_a", "n_b", state.alias("state"))


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its component: one document of each group of near copies.

    Of several rows with one doc_id, one stays: the least by text, then by its other columns as JSON.
    Rows without doc_id all stay, since nothing names them. Columns may have any names.
    """
    key, once = fresh_name(docs, "kept"), fresh_name(docs, "once")
    ids = ngram_jaccard_join(docs).where("doc_id = component_id").groupBy(F.col("doc_id").alias(key)).agg((F.count(F.lit(1)) == 1).alias(once))
    named = docs.where("doc_id is not null").join(ids, F.col("doc_id").cast("long") == F.col(key))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    many = named.where(f"not {once}").groupBy(key).agg(F.min_by(row, F.struct(F.col("text").cast("string"), F.to_json(row))).alias(once)).select(f"{once}.*")
    return named.where(once).select(*docs.columns).unionByName(many).unionByName(docs.where("doc_id is null"))
