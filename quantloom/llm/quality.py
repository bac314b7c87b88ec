"""Quality classifier from weak labels.

Overlapping heuristics vote on each document: good, bad or no opinion. Expectation-maximisation over
the counts of all documents' vote patterns estimates how accurate each heuristic is, without any true
label. The posterior labels train a linear scorer over hashed word shapes, and the scorer decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, saved
from .wordcodes import Words, mix, text_blocks, words_of

LABELLERS = ("symbols", "endings", "capitals", "shouting", "bars", "bare_signs", "repeats", "variety", "prose", "flow")
BUCKETS = 256
SAMPLE_ROWS = 12_000  # documents that the scorer is trained on at most, the first by hash of their texts
_SHAPES = 5  # figures of the whole text beside the hashed shapes, the constant included
WIDTH = BUCKETS + _SHAPES

_CLASS = np.full(256, 4, np.uint8)  # other signs
_CLASS[0x80:] = 1
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, *range(9, 14)]] = 0
_SIGN = np.where(_CLASS == 4, np.arange(256), _CLASS.astype(np.int64) + 256).astype(np.uint64)


def _shape_codes(data: np.ndarray, words: Words) -> np.ndarray:
    """A code of each word's shape: letters, capitals and digits as classes, other signs as themselves, runs as one."""
    sign = _SIGN[data]
    first = np.concatenate(([True], sign[1:] != sign[:-1]))
    first[words.starts] = True
    first &= _CLASS[data] > 0
    at = np.flatnonzero(first)
    word = np.searchsorted(words.starts, at, "right") - 1
    place = np.arange(len(at)) - np.searchsorted(at, words.starts)[word]
    part = mix(sign[at] * np.uint64(64) + np.minimum(place, 63).astype(np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part)))
    edges = np.searchsorted(at, np.append(words.starts, len(data)))
    return mix(total[edges[1:]] - total[edges[:-1]])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_measures(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(votes, features) of the rows of a block; votes are 1 good, 0 bad, -1 no opinion, a column for each labeller."""
    words = words_of(data, bounds)
    n_rows = len(bounds) - 1
    count = np.diff(words.offsets)
    some = np.maximum(1, count)
    kind = _CLASS[data]
    size = np.maximum(1, _sums(kind > 0, bounds))
    symbols, capitals, letters = _sums(kind == 4, bounds) / size, _sums(kind == 2, bounds), np.maximum(1, _sums((kind == 1) | (kind == 2), bounds))
    bars = _sums(data == ord("|"), bounds) / some
    shouts = _sums(data == ord("!"), bounds) / some
    again = np.zeros(len(words.codes), bool)
    again[1:] = words.codes[1:] == words.codes[:-1]
    again[words.offsets[:-1][count > 0]] = False
    repeats = _sums(again, words.offsets) / some
    rows = words.rows()
    order = np.lexsort((words.codes, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (words.codes[order][1:] != words.codes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    variety = np.bincount(rows[order], fresh, n_rows) / some
    signed = _sums(kind[words.ends - 1] == 4, words.offsets) / some if len(words.ends) else np.zeros(n_rows)
    breaks = _sums(data == ord("\n"), bounds) / some

    is_letter = np.concatenate((np.zeros(1, np.int64), np.cumsum((kind > 0) & (kind < 4))))
    bare = _sums(is_letter[words.ends] == is_letter[words.starts], words.offsets) / some
    shares = capitals / letters
    longer = count >= 20
    votes = np.full((n_rows, len(LABELLERS)), -1, np.int8)
    # most say only what they know: bad, or good
    for j, bad in enumerate((symbols > 0.15, signed > 0.6, shares > 0.4, shouts > 0.3, bars > 0.2, bare > 0.15, repeats > 0.2, variety < 0.15)):
        votes[bad & (longer if j in (1, 7) else count >= 5), j] = 0
    votes[(symbols < 0.1) & (signed < 0.4) & (shares < 0.25) & (bare < 0.05) & (repeats < 0.1), 8] = 1
    votes[longer & (repeats < 0.05) & (variety > 0.2) & (symbols < 0.1) & (bare < 0.05), 9] = 1
    votes[count == 0] = -1
    x = np.zeros((n_rows, WIDTH))
    if len(words.codes):
        bucket = (_shape_codes(data, words) % np.uint64(BUCKETS)).astype(np.int64)
        x[:, :BUCKETS] = np.bincount(rows * BUCKETS + bucket, minlength=n_rows * BUCKETS).reshape(n_rows, BUCKETS) / some[:, None]
    x[:, BUCKETS:] = np.stack([repeats, np.where(longer, variety, 0.5), symbols, breaks, np.ones(n_rows)], axis=1)
    return votes, x


def estimate_accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """(share of good documents, share of each labeller's votes that are right), by expectation-maximisation.

    A labeller without opinion says nothing; all start as right in 8 of 10 votes.
    """
    right, good = np.full(patterns.shape[1], 0.8), 0.5
    voted = patterns >= 0
    for _ in range(rounds):
        p = posterior(patterns, good, right)
        before, good = good, float(np.clip((p * counts).sum() / max(1e-9, counts.sum()), 0.05, 0.95))
        agreed = np.where(patterns == 1, p[:, None], 1 - p[:, None]) * voted * counts[:, None]
        # two votes in favour and one against come on top, so a labeller with few votes stays near its start
        right = np.clip((agreed.sum(axis=0) + 2) / ((voted * counts[:, None]).sum(axis=0) + 2.5), 0.55, 0.99)
        if abs(good - before) < 1e-9:
            break
    return good, right


def posterior(patterns: np.ndarray, good: float, right: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    odds = np.log(right / (1 - right)) * np.where(patterns == 1, 1.0, np.where(patterns == 0, -1.0, 0.0))
    return 1 / (1 + np.exp(-np.clip(np.log(good / (1 - good)) + odds.sum(axis=1), -500, 500)))


def _pattern_of(votes: np.ndarray) -> np.ndarray:
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def _text_codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a code of each row's words, which rows have no words)."""
    words = words_of(data, bounds)
    folded = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words.codes))))
    return mix(folded[words.offsets[1:]] - folded[words.offsets[:-1]]).view(np.int64), np.diff(words.offsets) == 0


def _votes_of(pattern: np.ndarray) -> np.ndarray:
    return (pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)


def train_quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the scorer, accuracies of the labellers): votes of all documents, scorer on a bounded sample of them."""
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # vote patterns of all documents and, of each with words, a code that picks the sample
        for batch in batches:
            for _, data, bounds in text_blocks(batch.column("text")):
                codes, wordless = _text_codes(data, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(_pattern_of(text_measures(data, bounds)[0])), pa.array(codes, mask=wordless)], ["pattern", "code"])

    votes = saved(texts.mapInArrow(vote, "pattern long, code long"), "votes")
    got = votes.groupBy("pattern").count().toPandas()  # 3 ** labellers rows at most
    patterns, counts = _votes_of(got["pattern"].to_numpy(np.int64)), got["count"].to_numpy(np.float64)
    good, right = estimate_accuracies(patterns, counts)
    picked = votes.where("code is not null").select("code").distinct().orderBy("code").limit(sample_rows)
    edge = picked.agg(F.max("code")).first()[0]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, data, bounds in text_blocks(batch.column("text")):
                codes, wordless = _text_codes(data, bounds)
                take = [i for i in np.flatnonzero((codes <= edge) & ~wordless).tolist() if not (codes[i] in seen or seen.add(codes[i]))]
                if take:
                    v, x = text_measures(np.concatenate([data[bounds[i] : bounds[i + 1]] for i in take]), np.concatenate(([0], np.cumsum(np.diff(bounds)[take]))))
                    features = pa.ListArray.from_arrays(pa.array(np.arange(len(take) + 1, dtype=np.int32) * WIDTH), pa.array(x.astype(np.float32).reshape(-1)))
                    yield pa.RecordBatch.from_arrays([pa.array(codes[take]), pa.array(_pattern_of(v)), features], ["code", "pattern", "x"])

    weights = np.zeros(WIDTH)
    if edge is not None:
        rows = texts.mapInArrow(sample, "code long, pattern long, x array<float>").dropDuplicates(["code"]).toPandas()
        # a text without words says nothing of quality and is no example
        x = np.stack(rows["x"].to_list()).astype(np.float64)
        label = posterior(_votes_of(rows["pattern"].to_numpy(np.int64)), good, right)
        weights = fit_logistic(x, label, l2=0.05)
    return weights, right


def _scores(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    parts = [text_measures(data, bounds)[1] @ weights for _, data, bounds in text_blocks(column)]
    return 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -500, 500))) if parts else np.zeros(0)


def score_quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: doc_id, quality in 0..1, accepted (quality >= 0.5).

    No labels are used. A text without words, null included, is scored like any other, by the constant
    and the figures of an empty text. Copies of one text have one score and count once in the training
    sample. An empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train_quality(docs, sample_rows)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = _scores(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(quality), pa.array(quality >= 0.5)], ["doc_id", "quality", "accepted"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, quality double, accepted boolean")


def keep_quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns, whatever their names.

    A null text counts as empty and is judged as in ``score_quality``; null and repeated ids, which play no
    part, stay as they are. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train_quality(docs, sample_rows)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column("text")) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
