"""Benchmark decontamination by spaced-seed hashing.

A seed mask lays a pattern over a run of words and ignores some of its positions, so a run with
substituted words at ignored positions keeps its hash. Hashes of benchmark items meet hashes of the
training texts; around each hit the two word sequences are compared along the hit's diagonal, and a
stretch of enough words, of which a stated share agrees, is a leak.

No leak is missed. Of a leak of 26 words or more one half is a leak too, so each one holds a leak of 13 to
25 words, and some mask fits between its substitutions wherever they stand. Items shorter than that
are cut in one part more than they may have substitutions, so one part agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcodes import mix, text_blocks, words_of

MASKS = ("11111011", "11100101011", "11100000010111", "1101001111", "111011101")  # meet every placement that the next two allow
MIN_WORDS = 13  # a leak is as long at least, or as long as the whole item if that is shorter
MIN_SHARE = 0.8  # of its words agree
SLICE_WORDS = 1_000_000  # of the benchmark that are sent to the executors at once: 16 bytes a word and as many a seed and mask
_FILTER_BITS = 22
_REACH = 2 * MIN_WORDS - 1  # every leak holds one of at most so many words
_HITS = 1 << 15  # compared at once
_STEPS = np.random.default_rng(0xDEC0).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each stretch ``codes[starts:stops]``; equal stretches have equal hashes wherever they stand."""
    n = len(codes)
    up = np.ones(n + 1, np.uint64)
    up[1:] = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * up[:n])))
    # all are brought to the same power
    return mix((total[stops] - total[starts]) * up[n - starts] + (stops - starts).astype(np.uint64))


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def seed_hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of ``mask`` laid at each place of ``codes`` where it fits."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in _offsets(mask):
        total += codes[i : i + n] * _STEPS[i]
    return mix(total)


class _Seeds:
    """Hashes of one benchmark slice: sorted, with item and place, and a bit table in front of them."""

    def __init__(self, items: list[tuple[object, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.codes = [c for _, c in items]
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate(self.codes or [np.zeros(0, np.uint64)])
        seeds: dict[str, list[tuple[np.ndarray, int, int]]] = {}  # by mask: hashes of an item from a place on
        for k, c in enumerate(self.codes):
            if len(c) >= MIN_WORDS:
                for mask in MASKS:
                    seeds.setdefault(mask, []).append((seed_hashes(c, mask), k, 0))
            else:
                for part in np.array_split(np.arange(len(c)), len(c) // 5 + 1):
                    mask = "1" * len(part)
                    seeds.setdefault(mask, []).append((seed_hashes(c[part], mask), k, int(part[0])))
        self.tables = []
        for mask, found in seeds.items():
            item = np.repeat(np.array([k for _, k, _ in found], np.int32), [len(h) for h, _, _ in found])
            place = np.concatenate([np.arange(p, p + len(h), dtype=np.int32) for h, _, p in found])
            flat = np.concatenate([h for h, _, _ in found])
            order = np.argsort(flat, kind="stable")
            flat, item, place = flat[order], item[order], place[order]
            begin, end = self.begins[item], self.begins[item] + self.sizes[item]
            own = window_hashes(self.flat, np.maximum(begin, begin + place - _REACH), np.minimum(end, begin + place + _REACH)) + np.minimum(place, _REACH).astype(np.uint64)
            alike = np.lexsort((place, own, item, flat))  # of places with one hash, item and surroundings the first is enough to tell whether there is a leak
            first = np.ones(len(flat), bool)
            first[alike[1:]] = (flat[alike[1:]] != flat[alike[:-1]]) | (item[alike[1:]] != item[alike[:-1]]) | (own[alike[1:]] != own[alike[:-1]])
            near = np.zeros(1 << _FILTER_BITS, bool)
            near[(flat >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.tables.append((mask, flat, item, place, near, first))

    def diagonals(self, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, item, diagonals) where hits have a leak around them; a diagonal is the place in the row minus that in the item.

        ``offsets`` tells where the rows begin in ``codes``. Where words repeat so much that a mask has more hits
        than there are words, hits with equal surroundings are looked at once, and all diagonals of the rows
        and items that they belong to are given, those with equal words under the item once.
        """
        found: dict[tuple[int, int], set[int]] = {}
        crowded: set[tuple[int, int]] = set()
        for mask, flat, item, place, near, first in self.tables:
            own = seed_hashes(codes, mask)
            at = np.flatnonzero(near[(own >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            lo = np.searchsorted(flat, own[at], "left")
            counts = np.searchsorted(flat, own[at], "right") - lo
            at, lo, counts = at[counts > 0], lo[counts > 0], counts[counts > 0]
            many = int(counts.sum()) > len(codes)
            groups = np.arange(len(at))
            if many:
                around = window_hashes(codes, np.maximum(0, at - _REACH), np.minimum(len(codes), at + _REACH)) + np.minimum(at, _REACH).astype(np.uint64)
                _, one, groups = np.unique(around, return_index=True, return_inverse=True)
                full = at
                at, lo, counts = at[one], lo[one], counts[one]
            stops = np.cumsum(counts)
            for begin in range(0, int(counts.sum()), _HITS):
                n = np.arange(begin, min(begin + _HITS, int(stops[-1])))
                j = np.searchsorted(stops, n, "right")
                k = lo[j] + n - (stops[j] - counts[j])
                if many:
                    j, k = j[first[k]], k[first[k]]
                leaks = self._leaks_around(codes, at[j], item[k], place[k].astype(np.int64))
                j, k = j[leaks], k[leaks]
                if many:
                    for g in np.unique(j).tolist():
                        rows = np.unique(np.searchsorted(offsets, full[groups == g], "right") - 1).tolist()
                        crowded.update((r, i) for r in rows for i in np.unique(item[k[j == g]]).tolist())
                else:
                    for d, i in set(zip((at[j] - place[k]).tolist(), item[k].tolist())):
                        # a hit belongs to the row of the words that the item's stretch lies on
                        last = int(np.searchsorted(offsets, min(len(codes), d + int(self.sizes[i])) - 1, "right")) - 1
                        for r in range(int(np.searchsorted(offsets, max(0, d), "right")) - 1, last + 1):
                            found.setdefault((r, i), set()).add(d - int(offsets[r]))
        for r, i in sorted(found.keys() | crowded):
            size, n = int(self.sizes[i]), int(offsets[r + 1] - offsets[r])
            some = np.array(sorted(found.get((r, i), ())), np.int64)
            if (r, i) in crowded:
                some = np.arange(1 - size, n)
                row = codes[offsets[r] : offsets[r + 1]]
                starts, stops = np.maximum(0, some), np.minimum(n, some + size)
                alike = window_hashes(row, starts, stops) + np.where(some < 0, some, 0).astype(np.uint64)  # what hangs over in front counts too
                some = some[np.unique(alike, return_index=True)[1]]
            yield r, i, some[(some > -size) & (some < n)]

    def _leaks_around(self, codes: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """For hits of ``codes`` from ``at`` and items from ``place`` on: whether there is a leak within reach, rows of texts not told apart."""
        steps = np.arange(-_REACH, _REACH)
        own, other = at[:, None] + steps, place[:, None] + steps
        size = self.sizes[item]
        inside = (own >= 0) & (own < len(codes)) & (other >= 0) & (other < size[:, None])
        same = codes[np.where(inside, own, 0)] == self.flat[np.where(inside, self.begins[item][:, None] + other, 0)]
        gain = np.zeros((len(at), len(steps) + 1), np.int32)
        np.cumsum(np.where(inside, np.where(same, 1, -4), -4 * len(steps)), axis=1, out=gain[:, 1:])
        low = np.minimum.accumulate(gain, axis=1)
        out, need = np.zeros(len(at), bool), np.minimum(MIN_WORDS, size)
        for words in np.unique(need).tolist():
            rows = need == words
            out[rows] = (gain[rows, words:] >= low[rows, :-words]).any(axis=1)
        return out

    def leak(self, codes: np.ndarray, diagonal: int, item: int) -> tuple[int, int] | None:
        """(words, agreeing words) of the best stretch along a diagonal if that is a leak."""
        other = self.codes[item]
        lo, hi = max(0, diagonal), min(len(codes), diagonal + len(other))
        same = codes[lo:hi] == other[lo - diagonal : hi - diagonal]
        # an agreeing word pays what a differing one costs at the required share, in whole numbers
        gain = np.concatenate(([0], np.cumsum(np.where(same, 1, -4))))
        need = min(MIN_WORDS, len(other))
        if len(same) < need:
            return None
        # the longest stretch that does not lose: for each end the first start with a total as low
        low = np.minimum.accumulate(gain)
        starts = np.searchsorted(-low, -gain)
        sizes = np.arange(len(gain)) - starts
        end = int(np.argmax(sizes))
        if sizes[end] < need:
            return None
        return int(sizes[end]), int(same[starts[end] : end].sum())


def benchmark_slices(benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> Iterator[_Seeds]:
    """The benchmark in slices of about ``slice_words`` words, each small enough to send to all executors."""
    rows = benchmark.select(F.col("item_id").try_cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // slice_words))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        got = part.orderBy("item_id", "text").collect()
        items = []
        for r in got:
            data = np.frombuffer(r["text"].encode(), np.uint8)
            items.append((r["item_id"], words_of(data, np.array([0, len(data)])).codes))
        yield _Seeds([x for x in items if len(x[1])])


def find_leaks(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(doc_id, item_id, n_words, n_same) for every document and benchmark item that leaks into it.

    Words are compared with A-Z lowered. Null and empty texts on either side have no words and meet
    nothing; an empty table on either side gives no rows; repeated documents give repeated rows;
    repeated items are reported by their own ids, items without a whole number as id by null; other columns are ignored. The benchmark is taken in
    slices of bounded size, so it may be of any length; ``docs`` is read once for each slice.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark, out = docs.sparkSession, None
    for seeds in benchmark_slices(benchmark, slice_words):
        shared = spark.sparkContext.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), []
                for row, leaks in _leaking(batch.column("text"), shared.value):
                    rows += [(ids[row], shared.value.ids[item], *size) for item, size in sorted(leaks.items())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "item_id", "n_words", "n_same"])

        part = texts.mapInArrow(run, "doc_id long, item_id long, n_words long, n_same long")
        out = part if out is None else out.union(part)
    return out


def _leaking(column: pa.Array, seeds: _Seeds) -> Iterator[tuple[int, dict[int, tuple[int, int]]]]:
    for row, data, bounds in text_blocks(column):
        words = words_of(data, bounds)
        leaks: dict[int, dict[int, tuple[int, int]]] = {}
        for i, item, diagonals in seeds.diagonals(words.codes, words.offsets):
            codes = words.codes[words.offsets[i] : words.offsets[i + 1]]
            got = [x for d in diagonals.tolist() if (x := seeds.leak(codes, d, item))]
            if got:
                leaks.setdefault(i, {})[item] = max(got)
        for i in sorted(leaks):
            yield row + i, leaks[i]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``docs`` without the rows into which a benchmark item leaks; see ``find_leaks``."""
    spark = docs.sparkSession
    for seeds in benchmark_slices(benchmark, slice_words):
        shared = spark.sparkContext.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _ in _leaking(batch.column("text"), shared.value):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
