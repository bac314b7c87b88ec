"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class, times that of its subclass in the class, times that of
the word in its subclass. The most frequent training words and the end of a text are classes of their own;
the others share classes by their endings, and subclasses by a hash of the whole word, so words never seen
have both. Class and subclass each come from a maximum-entropy model over n-gram and skip features of the
real words before, hashed into a table whose rows grow with the distinct training words up to a fixed
number, since all tasks hold it. In the last factor words count as in the training texts.

The table is trained by rounds over all training tokens: each task takes gradient steps (seen less
expected counts of each feature) on its own documents, in sparse numpy batches, and the tasks' rows are
averaged by feature row in a shuffle.

Texts are tokenised once, into blocks with a vocabulary of their own. Only the blocks' vocabularies meet
in the shuffles, each word once a block, so a word that is everywhere weighs no more than the number of
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, id_bucket, partitions, saved
from .wordcodes import mix, text_blocks, words_of

BLOCK_WORDS = 1_000_000  # a block is closed at so many words or more
OWN_CLASSES = 15
END_CLASSES = 16
SUBCLASSES = 16
CELLS = END_CLASSES * SUBCLASSES  # a shared class with a subclass
CLASSES = OWN_CLASSES + END_CLASSES + 1  # the last is the end of a text
END = CLASSES - 1
WIDTH = CLASSES + SUBCLASSES  # weights of a feature row
LEAST_ROWS, MOST_ROWS = 1 << 10, 1 << 16  # hashed feature rows: 12 MB at most
ROUNDS = 1
STEP_TOKENS = 8192  # tokens of a gradient step
RATE = 0.1
PIECE_ROWS = 256  # feature rows that are averaged together
_END_CODE = np.uint64(0x5EED)


def _pack(a: np.ndarray) -> bytes:
    """Byte planes of an array, compressed."""
    raw = np.ascontiguousarray(np.frombuffer(a.tobytes(), np.uint8).reshape(-1, a.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def _unpack(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    width = np.dtype(kind).itemsize
    return np.frombuffer(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).tobytes(), kind)


def _blocks(buckets: int):
    """Rows of a block: one with its documents and tokens (bucket -1), and its vocabulary in buckets of codes."""

    def close(block, ids, held, parts):
        codes = np.concatenate([p[0] for p in parts])
        endings = np.concatenate([p[1] for p in parts])
        sizes = np.concatenate([p[2] for p in parts])
        vocab, first, local, count = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")  # frequent words get low numbers
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        local, vocab = rank[local], vocab[order]
        mixed = mix(vocab)
        cells = endings[first][order] * np.uint8(SUBCLASSES) + (mixed & np.uint64(SUBCLASSES - 1)).astype(np.uint8)
        names = (mixed >> np.uint64(48)).astype(np.uint16)  # what features know of a word
        train = np.repeat(~np.array(held, bool), sizes)
        seen = np.bincount(local[train], minlength=len(vocab))
        rows = [(block, -1, _pack(local.astype(np.int32)), _pack(sizes.astype(np.int64)), _pack(np.array([-1 if i is None else i for i in ids], np.int64)), bytes(bytearray(i is None for i in ids)), bytes(bytearray(held)), _pack(names))]
        bucket = (vocab >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.concatenate(([True], bucket[order[1:]] != bucket[order[:-1]], [True])))
        for i, j in zip(edges[:-1], edges[1:]):
            at = order[i:j]
            rows.append((block, int(bucket[at[0]]), _pack(at.astype(np.int32)), _pack(seen[at].astype(np.int64)), vocab[at].tobytes(), cells[at].tobytes(), b"", b""))
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.binary()] * 6))], names=["block", "bucket", "p1", "p2", "p3", "p4", "p5", "p6"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        ids, held, parts, n = [], [], [], 0
        for batch in batches:
            all_ids, all_held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for row, data, bounds in text_blocks(batch.column("text")):
                words = words_of(data, bounds)
                last = data[words.ends - 1].astype(np.uint64)
                before = data[np.maximum(words.ends - 2, words.starts)].astype(np.uint64)
                endings = (mix(last * np.uint64(256) + before) % np.uint64(END_CLASSES)).astype(np.uint8)
                stops = words.offsets[1:]  # an end token after each text
                parts.append((np.insert(words.codes, stops, _END_CODE), np.insert(endings, stops, 0), np.diff(words.offsets) + 1))
                ids += all_ids[row : row + len(bounds) - 1]
                held += all_held[row : row + len(bounds) - 1]
                n += len(words.codes)
                if n >= BLOCK_WORDS:
                    yield close(block, ids, held, parts)
                    block, ids, held, parts, n = block + 1, [], [], [], 0
        if parts:
            yield close(block, ids, held, parts)

    return run


_BLOCK_SCHEMA = "block long, bucket int, p1 binary, p2 binary, p3 binary, p4 binary, p5 binary, p6 binary"


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the words of one or more buckets, handed back to each block; and the buckets' totals (block null)."""
    blocks, local, seen, codes, cells, sizes = [], [], [], [], [], []
    for batch in batches:
        for block, p1, p2, p3, p4 in zip(batch.column("block").to_pylist(), *(batch.column(f"p{i}").to_pylist() for i in (1, 2, 3, 4))):
            blocks.append(block)
            local.append(p1)
            seen.append(_unpack(p2, np.int64))
            codes.append(np.frombuffer(p3, np.uint64))
            cells.append(np.frombuffer(p4, np.uint8))
            sizes.append(len(codes[-1]))
    if not blocks:
        return
    cells = np.concatenate(cells)
    vocab, first, at = np.unique(np.concatenate(codes), return_index=True, return_inverse=True)
    count = np.bincount(at, np.concatenate(seen)).astype(np.int64)
    cell = cells[first]
    word = vocab != _END_CODE
    top = np.flatnonzero(word & (count > 0))
    top = top[np.lexsort((vocab[top], -count[top]))][:OWN_CLASSES]
    is_top = np.zeros(len(vocab), bool)
    is_top[top] = True
    known = word & (count > 0)
    totals = np.concatenate([[count.sum(), (count > 0).sum(), count[~word].sum()], np.bincount(cell[known], count[known], CELLS), np.bincount(cell[known], minlength=CELLS)]).astype(np.int64)
    rows = [(None, vocab[top].tobytes(), count[top].tobytes(), cell[top].tobytes(), totals.tobytes(), b"")]
    edges = np.concatenate(([0], np.cumsum(sizes)))
    for block, own, a, b in zip(blocks, local, edges[:-1], edges[1:]):
        mine = np.flatnonzero(is_top[at[a:b]])
        # number, count and cell of each word of the block; place and code of those that may get a class of their own
        rows.append((block, own, _pack(count[at[a:b]]), cells[a:b].tobytes(), mine.astype(np.int32).tobytes(), vocab[at[a:b][mine]].tobytes()))
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[i : i + 64]), (pa.int64(), *[pa.binary()] * 5))], names=["block", "p1", "p2", "p3", "p4", "p5"])


class Corpus:
    """Training totals: N tokens, V distinct; which words have classes of their own; counts and words of shared cells."""

    def __init__(self, rows):
        totals = np.zeros(3 + 2 * CELLS, np.int64)
        codes, counts, cells = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
        for r in rows:
            codes.append(np.frombuffer(r["p1"], np.uint64))
            counts.append(np.frombuffer(r["p2"], np.int64))
            cells.append(np.frombuffer(r["p3"], np.uint8))
            totals += np.frombuffer(r["p4"], np.int64)
        codes, counts, cells = map(np.concatenate, (codes, counts, cells))
        best = np.lexsort((codes, -counts))[:OWN_CLASSES]
        self.tokens, self.distinct, self.ends = (int(x) for x in totals[:3])
        self.own = {int(c): k for k, c in enumerate(codes[best])}
        self.own_count = counts[best]
        self.shared_count = totals[3 : 3 + CELLS] - np.bincount(cells[best], counts[best], CELLS).astype(np.int64)
        self.shared_words = totals[3 + CELLS :] - np.bincount(cells[best], minlength=CELLS)

    def rows(self) -> int:
        """Feature rows: an eighth of the distinct training words, in a power of two between the bounds."""
        return min(MOST_ROWS, max(LEAST_ROWS, 1 << (self.distinct // 8).bit_length()))

    def start(self) -> np.ndarray:
        """The constant's weights that give each class its share of the training tokens."""
        by_class = np.zeros(CLASSES)
        by_class[: len(self.own_count)] = self.own_count
        by_class[OWN_CLASSES:END] = self.shared_count.reshape(END_CLASSES, SUBCLASSES).sum(axis=1)
        by_class[END] = self.ends
        return np.concatenate((np.log((by_class + 0.5) / (by_class.sum() + 0.5 * CLASSES)), np.zeros(SUBCLASSES))).astype(np.float32)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def _documents(corpus):
    """(doc_id, held_out, n_tokens, n_known, base_score, inner, tokens) of each document, from rows of blocks sorted by
    block and bucket; ``tokens`` has the name, class and subclass of each."""

    def finish(tokens: dict, vocab: list[dict]) -> pa.RecordBatch:
        known: Corpus = corpus.value
        numbers = _unpack(tokens["p1"], np.int32)
        sizes = _unpack(tokens["p2"], np.int64)
        n = int(numbers.max()) + 1
        count, kind, sub = np.zeros(n, np.int64), np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        inner, names = np.zeros(n), _unpack(tokens["p6"], np.uint16).astype(np.uint32)
        for v in vocab:
            at = _unpack(v["p1"], np.int32)
            count[at] = _unpack(v["p2"], np.int64)
            cell = np.frombuffer(v["p3"], np.uint8)
            kind[at], sub[at] = OWN_CLASSES + cell // SUBCLASSES, cell % SUBCLASSES
            inner[at] = np.log10((count[at] + 0.5) / (known.shared_count[cell] + 0.5 * (known.shared_words[cell] + 1)))
            for i, code in zip(np.frombuffer(v["p4"], np.int32), np.frombuffer(v["p5"], np.uint64).tolist()):
                if code in known.own:
                    kind[at[i]], sub[at[i]], inner[at[i]] = known.own[code], 0, 0.0
        stops = np.cumsum(sizes)
        end = numbers[stops[0] - 1]  # each text closes with the end token
        kind[end], sub[end], inner[end] = END, 0, 0.0
        offsets = np.concatenate(([0], stops))

        def sums(x):
            total = np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))
            return total[offsets[1:]] - total[offsets[:-1]]

        packed = (names | (kind << np.uint32(16)) | (sub << np.uint32(24)))[numbers]
        base = np.add.reduceat(known.base(count)[numbers], offsets[:-1])
        missing = np.frombuffer(tokens["p4"], np.uint8).astype(bool)
        columns = [
            pa.array(_unpack(tokens["p3"], np.int64), mask=missing),
            pa.array(np.frombuffer(tokens["p5"], np.uint8).astype(bool)),
            pa.array(sizes),
            pa.array(sums((count > 0)[numbers]).astype(np.int64)),
            pa.array(base),
            pa.array(np.add.reduceat(inner[numbers], offsets[:-1])),
            pa.array([_pack(packed[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, vocab = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] == -1:
                    if tokens is not None:
                        yield finish(tokens, vocab)
                    tokens, vocab = row, []
                else:
                    vocab.append(row)
        if tokens is not None:
            yield finish(tokens, vocab)

    return run


# --- the maximum-entropy model: before a text stands its end token, twice

_END_NAME = int(mix(np.array([_END_CODE]))[0] >> np.uint64(48))
_TEMPLATES = ((0,), (0, 1), (1,))  # n-grams of the word before and the two before; a skip to the second before


class Tokens:
    """Tokens of some texts: feature rows of their contexts, classes and subclasses; row ``rows`` of the table is the constant."""

    def __init__(self, texts: list[np.ndarray], rows: int):
        before = []
        for t in texts:
            own = np.concatenate((np.full(2, _END_NAME, np.uint64), (t & np.uint32(0xFFFF)).astype(np.uint64)))
            before.append(np.stack((own[1:-1], own[:-2])))
        flat = np.concatenate(texts)
        self.kind = (flat >> np.uint32(16) & np.uint32(0xFF)).astype(np.int64)
        self.sub = (flat >> np.uint32(24)).astype(np.int64)
        self.shared = (self.kind >= OWN_CLASSES) & (self.kind != END)
        before = np.concatenate(before, axis=1)
        self.rows = np.empty((len(_TEMPLATES), len(flat)), np.uint16)  # MOST_ROWS fit
        for k, template in enumerate(_TEMPLATES):
            code = np.full(len(flat), k + 1, np.uint64)
            for i in template:
                code = mix(code * np.uint64(0x10001) + before[i])
            self.rows[k] = (code % np.uint64(rows)).astype(np.uint16)

    def __len__(self) -> int:
        return len(self.kind)

    def log_probabilities(self, weights: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms of the class's and subclass's probabilities, for all of them."""
        total = weights[self.rows[0, part]] + weights[-1]
        for own in self.rows[1:]:
            total += weights[own[part]]
        out = []
        for x in (total[:, :CLASSES], total[:, CLASSES:]):
            x = x - x.max(axis=1, keepdims=True)
            out.append(x - np.log(np.exp(x).sum(axis=1, keepdims=True)))
        return out[0], out[1]


def _texts(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[list[np.ndarray]]:
    """Texts of about so many tokens together."""
    held, n = [], 0
    for batch in batches:
        for packed in batch.column("tokens"):
            held.append(_unpack(packed.as_py(), np.uint32))
            n += len(held[-1])
            if n >= tokens:
                yield held
                held, n = [], 0
    if held:
        yield held


def gradient(tokens: Tokens, weights: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, seen less expected, uses) of each feature row of some tokens."""
    at = np.arange(len(tokens))[part]
    one, two = (np.exp(x) for x in tokens.log_probabilities(weights, part))
    miss = -np.concatenate((one, np.where(tokens.shared[at, None], two, 0)), axis=1)
    n = np.arange(len(at))
    miss[n, tokens.kind[at]] += 1
    miss[n[tokens.shared[at]], CLASSES + tokens.sub[at][tokens.shared[at]]] += 1
    rows = tokens.rows[:, part].reshape(-1)
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], rows[order[1:]] != rows[order[:-1]])))
    slopes = np.add.reduceat(miss[order % len(at)], starts, axis=0)
    return (
        np.append(rows[order[starts]].astype(np.int64), len(weights) - 1),
        np.concatenate((slopes, miss.sum(axis=0, keepdims=True))),
        np.append(np.diff(np.append(starts, len(order))), len(at)),
    )


def _trained(shared, rows: int):
    """The rows that a task moved, times how often it used them, and these uses, in pieces of PIECE_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, power = shared.value
        weights, power, uses = start.copy(), power.copy(), np.zeros(rows + 1)
        for texts in _texts(batches, 16 * STEP_TOKENS):
            tokens = Tokens(texts, rows)
            for a in range(0, len(tokens), STEP_TOKENS):
                own, slope, n = gradient(tokens, weights, slice(a, a + STEP_TOKENS))
                power[own] += (slope * slope).mean(axis=1)
                weights[own] += (RATE / np.sqrt(power[own]))[:, None] * slope
                uses[own] += n
        used = np.unique(np.flatnonzero(uses) // PIECE_ROWS)
        for piece in used.tolist():
            part = slice(piece * PIECE_ROWS, (piece + 1) * PIECE_ROWS)
            n = uses[part].astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in (weights[part] * n[:, None], power[part] * n, n)], names=["piece", "weights", "power", "uses"])

    return run


_PIECES = "piece int, weights binary, power binary, uses binary"


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for piece, *own in zip(batch.column("piece").to_pylist(), *(batch.column(c).to_pylist() for c in ("weights", "power", "uses"))):
            own = [np.frombuffer(x, np.float32).copy() for x in own]
            if piece in total:
                for x, y in zip(total[piece], own):
                    x += y
            else:
                total[piece] = own
    for piece, (weights, power, uses) in total.items():
        n = np.maximum(uses, 1)
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in ((weights.reshape(-1, WIDTH) / n[:, None]), power / n, uses)], names=["piece", "weights", "power", "uses"])


def train(tokens: DataFrame, rows: int, start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the hashed feature rows, the constant's last, from ``tokens(tokens)`` of the training texts; the constant begins at ``start``.

    A round goes over all tokens, in as many tasks as run at once, each of which starts from the weights of the
    round before. Rows that no token used stay 0.
    """
    spark = tokens.sparkSession
    weights, power = np.zeros((rows + 1, WIDTH), np.float32), np.full(rows + 1, 1e-2, np.float32)
    weights[-1] = start
    slots = max(1, spark.sparkContext.defaultParallelism)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((weights, power))
        moved = tokens.coalesce(slots).mapInArrow(_trained(shared, rows), _PIECES)
        weights, power = weights.copy(), power.copy()
        for r in moved.repartition(partitions(spark), "piece").mapInArrow(_averaged, _PIECES).collect():  # (rows + 1) / PIECE_ROWS rows at most
            used = np.frombuffer(r["uses"], np.float32) > 0
            part = slice(r["piece"] * PIECE_ROWS, r["piece"] * PIECE_ROWS + len(used))
            weights[part][used] = np.frombuffer(r["weights"], np.float32).reshape(-1, WIDTH)[used]
            power[part][used] = np.frombuffer(r["power"], np.float32)[used]
        shared.unpersist()
    return weights


def text_scores(texts: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The decimal logarithm of the classes' and subclasses' probabilities in each text."""
    tokens = Tokens(texts, len(weights) - 1)
    got = np.empty(len(tokens))
    for a in range(0, len(tokens), STEP_TOKENS):
        part = slice(a, a + STEP_TOKENS)
        n = np.arange(len(tokens.kind[part]))
        one, two = tokens.log_probabilities(weights, part)
        got[part] = one[n, tokens.kind[part]] + np.where(tokens.shared[part], two[n, tokens.sub[part]], 0)
    return np.add.reduceat(got, np.cumsum([0, *(len(t) for t in texts[:-1])])) / np.log(10)


def _score(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
        for batch in batches:
            if batch.num_rows:
                outer = np.concatenate([text_scores(t, weights.value) for t in _texts(iter([batch]), 16 * STEP_TOKENS)])
                score = outer + batch.column("inner").to_numpy()
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(score)], names=[*names, "score"])

    return run


def lm_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1. Null texts count as empty; an empty
    text has its end token only. Repeated rows count as often as they stand in the table. Without
    training rows all tokens are unknown and the model is uniform. An empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    n_parts = partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_bucket() % 5 == 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    blocks = saved(texts.mapInArrow(_blocks(n_parts), _BLOCK_SCHEMA), "blocks")
    words = blocks.where("bucket >= 0").repartition(n_parts, "bucket").mapInArrow(_sum_counts, "block long, p1 binary, p2 binary, p3 binary, p4 binary, p5 binary")
    words = saved(words, "words")
    corpus = Corpus(words.where("block is null").collect())  # a row a shuffle partition
    parts = words.where("block is not null").withColumn("bucket", F.lit(0)).withColumn("p6", F.lit(None).cast("binary")).unionByName(blocks.where("bucket = -1"))
    rows = parts.repartition(n_parts, "block").sortWithinPartitions("block", "bucket")
    scored = rows.mapInArrow(_documents(spark.sparkContext.broadcast(corpus)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double, tokens binary")
    scored = saved(scored, "scored")
    forget(blocks, words)
    weights = spark.sparkContext.broadcast(train(scored.where("not held_out").select("tokens"), corpus.rows(), corpus.start(), rounds))
    out = scored.withColumn("train_tokens", F.lit(corpus.tokens).cast("long"))
    return out.mapInArrow(_score(weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
