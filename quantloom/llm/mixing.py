"""Mixing sources to target weights, in words.

Each source's documents stand on one line of words, cut into blocks. A source's quota of blocks is split
among the output shards by a tree of multivariate-hypergeometric draws: a node holds how many blocks of each
source its shards get, and its left half draws its share of them without replacement. A shard's blocks are
then a stretch of the source's blocks in a permuted order, so draws are disjoint within a pass over the
source, and each shard shuffles its own blocks. Nothing depends on partitions, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, saved
from .places import Places

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # words in the mix for each word in the documents
MOST_PASSES = 2
BLOCK_WORDS = 256
LEAST_BLOCKS = 4096  # small sources have smaller blocks, so that quotas come near targets
SHARD_WORDS = 1 << 20
LEAST_SHARDS = 16
SEED = 20_240_613
WORD = r"[^\x20\x09-\x0D]+"
EXACT_POPULATION = 10**9  # numpy's bound


def source_targets(groups: DataFrame) -> DataFrame:
    """``groups(rank_, group_sum_)`` with ``target``: by weight, at most twice the source's size, the excess to the others.

    A round caps the sources above their bound, and the level of the others rises; only sums reach the driver.
    Sources without words have the target 0.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank_") % len(WEIGHTS) + 1).cast("int"))
    size = F.col("group_sum_").cast("double")
    total = groups.agg(F.sum("group_sum_")).first()[0] or 0
    capped: Column = F.lit(False)
    before = -1
    while True:
        n, words, rest = groups.agg(F.count_if(capped), F.sum(F.when(capped, F.col("group_sum_"))), F.sum(F.when(~capped, weight))).first()
        level = (SHARE * total - MOST_PASSES * (words or 0)) / rest if rest else 0.0
        if n == before or not rest:
            return groups.withColumn("target", F.when(capped, MOST_PASSES * size).otherwise(weight * F.lit(level)))
        before, capped = n, weight * F.lit(level) >= MOST_PASSES * size


def with_quotas(groups: DataFrame) -> DataFrame:
    """``block`` (words), ``blocks`` and ``quota`` (blocks that the mix takes) of each source: whole passes, then part of one."""
    out = groups.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.expr(f"group_sum_ div {LEAST_BLOCKS}"))).cast("long"))
    out = out.withColumn("blocks", F.expr("(group_sum_ + block - 1) div block"))
    passes = F.floor(F.col("target") / F.greatest(F.lit(1), F.col("group_sum_")))
    part = F.least(F.col("blocks"), F.floor((F.col("target") - passes * F.col("group_sum_")) / F.col("block") + 0.5))
    return out.withColumn("quota", (passes * F.col("blocks") + part).cast("long"))


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement are good. Beyond numpy's bound the normal limit is rounded, within what is possible."""
    if good + bad < EXACT_POPULATION:
        return int(rng.hypergeometric(good, bad, n)) if n and good + bad else 0
    total = good + bad
    mean, share = n * (good / total), good / total
    spread = np.sqrt(max(0.0, n * share * (1 - share) * ((total - n) / max(1, total - 1))))
    return int(min(max(round(rng.normal(mean, spread)), n - bad, 0), good, n))


def split_quotas(quotas: list[int], n: int, rng: np.random.Generator) -> list[int]:
    """How many blocks of each source are among n drawn from all; the sum is n."""
    out, rest = [], sum(quotas)
    for q in quotas:
        rest -= q
        took = _draw(rng, q, rest, n)
        out.append(took)
        n -= took
    return out


def shard_stretches(quotas: list[int], shard: int, shards: int) -> list[tuple[int, int]]:
    """The stretch of each source's draws that a shard gets: the way from the tree's root to its leaf."""
    total, low, high = sum(quotas), 0, shards
    counts, starts = list(quotas), [0] * len(quotas)
    first = lambda k: k * total // shards
    while high - low > 1:
        mid = (low + high) // 2
        left = split_quotas(counts, first(mid) - first(low), np.random.default_rng([SEED, low, high]))
        if shard < mid:
            counts, high = left, mid
        else:
            counts, starts, low = [c - x for c, x in zip(counts, left)], [s + x for s, x in zip(starts, left)], mid
    return [(s, s + c) for s, c in zip(starts, counts)]


def stretches(groups: DataFrame, shards: int) -> DataFrame:
    """(rank_, shard, from_, until_) of all shards; each shard walks down the tree on its own. A task holds the list of
    quotas, a number for each source."""
    spark = groups.sparkSession
    lists = groups.agg(F.array_sort(F.collect_list(F.struct("rank_", "quota"))).alias("of"))
    rows = spark.range(shards).withColumnRenamed("id", "shard").crossJoin(F.broadcast(lists))  # one row on the right

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, of in zip(batch["shard"], batch["of"]):
                ranks, quotas = [int(x["rank_"]) for x in of], [int(x["quota"]) for x in of]
                places = shard_stretches(quotas, int(shard), shards)
                yield pd.DataFrame([(r, int(shard), a, b) for r, (a, b) in zip(ranks, places) if a < b], columns=["rank_", "shard", "from_", "until_"]).astype("int64")

    return rows.mapInPandas(walk, "rank_ long, shard long, from_ long, until_ long")


_LOW = np.uint64(0xFFFFFFFF)


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where i stands in a permutation of 0..n-1 that ``key`` (32 bits) picks: four Feistel rounds on an even number of
    bits, walked on until the value is below n."""
    i, n, key = (np.asarray(x).astype(np.uint64) for x in (i, n, key))
    half = np.array([max(1, (int(x - 1).bit_length() + 1) // 2) for x in np.unique(n)], np.uint64)[np.unique(n, return_inverse=True)[1]] if len(n) else n
    mask, out, todo = (np.uint64(1) << half) - np.uint64(1), i.copy(), np.ones(len(i), bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            x = ((right ^ ((k + np.uint64(r * 0x85EBCA6B)) & _LOW)) * np.uint64(0x9E3779B1)) & _LOW
            x = ((x ^ (x >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & _LOW
            left, right = right, left ^ (x >> (np.uint64(32) - h)) & m
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def _permuted_series(i: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(i.to_numpy(), n.to_numpy(), key.to_numpy()))


def _laid_out(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with size, place on their source's line, and their source's target and quota; the sources."""
    group = F.when(F.col("source").isNull(), "2").otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sizes = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.alias("g_"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("h_")), "sizes")
    places = Places(sizes, "g_", ["doc_id", "size", "h_"], "size")
    forget(sizes)
    sources = saved(with_quotas(source_targets(places.groups)), "sources")
    rows = saved(places.rows(sources.select("g_", "target", "block", "blocks", "quota")), "laid")
    places.forget()
    return rows, sources


def _pieces(rows: DataFrame, shards: int) -> DataFrame:
    """The words of each drawn block, a row for each document in it, with the draw's place in its source and the slot of that place."""
    of = rows.where("size > 0 AND quota > 0").select("*", F.explode(F.expr("sequence(before_ div block, (before_ + size - 1) div block)")).alias("block_at"))
    of = of.select("*", F.explode(F.array(*[F.lit(i) for i in range(MOST_PASSES)])).alias("pass")).where("pass * blocks < quota")
    key = F.crc32(F.concat("g_", F.lit("/"), F.col("pass").cast("string")).cast("binary"))
    of = of.withColumn("place_", F.col("pass") * F.col("blocks") + F.pandas_udf(_permuted_series, "long")("block_at", "blocks", key)).where("place_ < quota")
    first, last = F.greatest(F.col("before_"), F.expr("block_at * block")), F.least(F.expr("before_ + size"), F.expr("(block_at + 1) * block"))
    return of.select("row_", "doc_id", "h_", "rank_", "before_", "pass", "block_at", "place_", F.expr(f"place_ div ({_width(shards)})").alias("slot"), (first - F.col("before_")).alias("from_word"), (last - first).alias("n_words"))


def _width(shards: int) -> str:
    """Draws of a slot: about as many as a shard gets of the source."""
    return f"(quota + {shards - 1}) div {shards}"


def _draws(rows: DataFrame, sources: DataFrame, shards: int | None) -> DataFrame:
    quotas = sources.where("quota > 0")
    if shards is None:
        words = quotas.agg(F.sum("target")).first()[0] or 0
        shards = max(LEAST_SHARDS, -(-int(words) // SHARD_WORDS))
    slots = F.explode(F.expr(f"sequence(from_ div ({_width(shards)}), (until_ - 1) div ({_width(shards)}))")).alias("slot")
    parts = stretches(quotas.select("rank_", "quota"), shards).join(quotas.select("rank_", "quota"), "rank_").select("rank_", "shard", "from_", "until_", slots)
    met = _pieces(rows, shards).join(parts, ["rank_", "slot"]).where("place_ >= from_ AND place_ < until_")
    return met.select("row_", "doc_id", "h_", "shard", F.xxhash64(F.lit(SEED), "rank_", "pass", "block_at").alias("turn"), "pass", "block_at", "before_", "from_word", "n_words")


def draw_mix(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix of ``docs(doc_id, source, text)``, a row for each stretch of a document's words that a shard takes:
    doc_id, shard, from_word (from 0) and n_words. In a shard, rows stand by turn, pass, block_at and before_."""
    return _draws(*_laid_out(docs), shards)


def mixed_texts(docs: DataFrame, draws: DataFrame) -> DataFrame:
    """``draws`` with their words as ``text``, dealt by shard and in their shuffled order there, ready to be written."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_"), F.xxhash64(text).alias("h_"), text.alias("text")).groupBy("id_", "h_").agg(F.first("text").alias("text"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    out = draws.withColumn("id_", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(texts, ["id_", "h_"]).withColumn("text", cut)
    return out.repartition("shard").sortWithinPartitions("shard", "turn", "pass", "block_at", "before_").select("shard", "doc_id", "from_word", "n_words", "text")


def mix_report(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """For each row of ``docs(doc_id, source, text)``: size (words), its source's size and target, and the words that the mix takes of it.

    Sources stand by code point, null last. Null and empty texts have size 0 and give nothing. Rows of one doc_id are
    rows of their own; equal ones may take different amounts. A source without words has the target 0. Other columns are
    ignored; an empty table gives no rows.
    """
    rows, sources = _laid_out(docs)
    taken = _draws(rows, sources, shards).groupBy("row_").agg(F.sum("n_words").alias("taken"))
    out = rows.join(taken, "row_", "left")
    return out.select("doc_id", "size", F.col("group_sum_").alias("source_size"), "target", F.coalesce("taken", F.lit(0)).alias("taken"))
