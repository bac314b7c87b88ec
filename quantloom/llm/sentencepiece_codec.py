"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is read here and rebuilt: normaliser, metaspace marker, pieces with their scores
(unigram models) or merges ranked by score (BPE models), and byte fallback. Texts are cut before each
run of metaspace markers where no piece spans such a cut, so each distinct chunk of a task is encoded
once, in multithreaded batches, and compared with the sentencepiece library for parity.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CACHE_CHUNKS = 400_000  # distinct chunks that a task remembers; then it starts anew
THREADS = 2  # of each worker; as many as the machine has cores would compete with the other tasks
MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class Model(NamedTuple):
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    unigram: bool
    byte_fallback: bool
    charsmap: bytes
    add_prefix: bool
    trim: bool
    raw: bytes

    @property
    def unknown(self) -> int:
        return self.kinds.index(_UNKNOWN)


def read_model(data: bytes) -> Model:
    """A model from the bytes of its protobuf."""
    pieces, scores, kinds = [], [], []
    trainer: dict = {}
    norm: dict = {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, _NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            norm = dict(_fields(value))
    kind = trainer.get(3, 1)
    if kind not in (1, 2):
        raise ValueError("only unigram and BPE models are supported")
    if trainer.get(24) or _USER in kinds:
        raise ValueError("models with markers behind words or with user-defined pieces are not supported")
    return Model(pieces, scores, kinds, kind == 1, bool(trainer.get(35, 0)), norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), data)


def build_tokenizer(model: Model):
    """The ``tokenizers.Tokenizer`` that encodes normalised text, and decodes ids, as the model does."""
    from tokenizers import Tokenizer, decoders, models

    vocab = {p: i for i, p in enumerate(model.pieces)}
    if model.unigram:
        core = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, model.byte_fallback)
    else:
        plain = {p for p, k in zip(model.pieces, model.kinds) if k in (_NORMAL, _USER)}
        merges = []
        for piece in sorted(plain, key=lambda p: (-model.scores[vocab[p]], vocab[p])):
            pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in plain and piece[i:] in plain]
            merges += sorted(pairs, key=lambda x: (vocab[x[0]], vocab[x[1]]))
        core = models.BPE(vocab, merges, unk_token=model.pieces[model.unknown], byte_fallback=model.byte_fallback, fuse_unk=True)
    tokenizer = Tokenizer(core)
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Codec:
    """Encodes and decodes texts; remembers distinct chunks."""

    def __init__(self, data: bytes):
        from tokenizers import Regex, normalizers

        self.model = read_model(data)
        self.tokenizer = build_tokenizer(self.model)
        steps = [normalizers.Precompiled(self.model.charsmap)] if self.model.charsmap else []
        if self.model.trim:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        # no piece goes on after a marker, so a text falls apart into runs of markers and what follows them; the first marker is left out of a chunk's key
        self.cut = self.model.add_prefix and not any(MARK in p.lstrip(MARK) for p, k in zip(self.model.pieces, self.model.kinds) if k in (_NORMAL, _USER))
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.odd: dict[int, str] = {}  # decoded chunks that are not the chunk itself
        # ids of all known chunks one after another; chunk i has ids[starts[i]:starts[i + 1]]
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.same, self.faithful = np.zeros(0, bool), np.zeros(0, bool)

    def chunks(self, text: str) -> list[str]:
        """Keys of the text's chunks."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return []
        if not self.cut:
            return [(MARK if self.model.add_prefix else "") + text.replace(" ", MARK)]
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            return [c[1:] for c in _CHUNK.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def learn(self, keys: list[str], processor=None) -> None:
        """Encode and decode chunks that are new; compare with ``processor`` if one is given."""
        names = list(set(keys).difference(self.known))
        if not names:
            return
        new = [MARK + k for k in names] if self.cut else names
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        faithful = np.array([b == c.replace(MARK, " ") for b, c in zip(back, new)], bool)
        self.odd.update((len(self.known) + i, back[i]) for i in np.flatnonzero(~faithful).tolist())
        self.faithful = np.concatenate((self.faithful, faithful))
        same = np.ones(len(new), bool)
        if processor is not None:  # the library adds a marker of its own in front
            lead = 1 if self.model.add_prefix else 0
            expected = processor.encode([c.replace(MARK, " ")[lead:] for c in new], num_threads=THREADS)
            # an empty text gets no marker, so the marker alone is looked up
            alone = [processor.piece_to_id(MARK)]
            same = np.array([a == (alone if c == MARK else b) for c, a, b in zip(new, ids, expected)], bool)
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(new))))
        self.same = np.concatenate((self.same, same))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), np.int32)))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum([len(i) for i in ids])))

    def encode(self, texts: list[str], processor=None) -> list[tuple[np.ndarray, str, bool]]:
        """(ids, decoded text, parity) of each text."""
        if len(self.known) > CACHE_CHUNKS:
            self._reset()
        cut = [self.chunks(t) for t in texts]
        self.learn(list(chain.from_iterable(cut)), processor)
        # equal normalised texts, and equal ids of each chunk, which no piece crosses, make equal ids of the text
        whole = [True] * len(cut) if processor is None else [a == self._marked(own) for a, own in zip(processor.normalize(texts), cut)]
        out = []
        for own, alike in zip(cut, whole):
            at = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
            starts = self.starts[at]
            sizes = self.starts[at + 1] - starts
            ends = np.cumsum(sizes)
            place = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            text = self._joined(own, at)
            out.append((self.ids[place], text[1:] if self.model.add_prefix and text[:1] == " " else text, alike and bool(self.same[at].all())))
        return out

    def _marked(self, keys: list[str]) -> str:
        """The normalised text, markers and all, that chunks make up."""
        lead = MARK if self.cut else ""
        return lead + lead.join(keys) if keys else ""

    def _joined(self, keys: list[str], at: np.ndarray) -> str:
        """The decoded text of chunks."""
        lead = MARK if self.cut else ""
        if self.faithful[at].all():
            return (lead + lead.join(keys)).replace(MARK, " ") if keys else ""
        return "".join([self.odd[i] if i in self.odd else (lead + k).replace(MARK, " ") for k, i in zip(keys, at.tolist())])

    def decode(self, ids: list[int]) -> str:
        text = self.tokenizer.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.add_prefix and text[:1] == " " else text


_codecs: dict[str, tuple[Codec, object]] = {}


def _codec(data: bytes) -> tuple[Codec, object]:
    """One codec a Python worker and model, with the library's own processor for parity."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _codecs:
        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        _codecs.clear()
        _codecs[key] = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    return _codecs[key]


def load_model(spark: SparkSession, path: str = MODEL_PATH):
    """The model file's bytes (read by the driver), as a broadcast variable; a model has a fixed size."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _arrays(results: list[tuple[np.ndarray, str, bool]]):
    offsets = np.concatenate(([0], np.cumsum([len(r[0]) for r in results]))).astype(np.int32)
    ids = np.concatenate([r[0] for r in results]) if results else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def encode_texts(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_ids``, ``round_trip`` and ``parity``, which replace columns of these names.

    A null text counts as empty and has no tokens. ``round_trip`` tells whether decoding gives the
    (normalised) text back, ``parity`` whether the sentencepiece library normalises the
    whole text alike and gives each of its chunks the same ids. A text's own
    U+2581 is the marker and decodes as a space. Rows are independent; an empty table gives no rows.
    """
    shared = load_model(docs.sparkSession, path)
    docs = docs.drop("n_tokens", "token_ids", "round_trip", "parity")
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType()), T.StructField("parity", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, processor = _codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                results = codec.encode(texts, processor)
                back = pa.array([_same_text(codec, t, r[1]) for t, r in zip(texts, results)], pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([len(r[0]) for r in results], pa.int64()), _arrays(results), back, pa.array([r[2] for r in results], pa.bool_())], names=[*part.schema.names, "n_tokens", "token_ids", "round_trip", "parity"])

    return docs.mapInArrow(run, schema)


def _same_text(codec: Codec, text: str, back: str) -> bool:
    if codec.normalizer is not None:
        text = codec.normalizer.normalize_str(text)
    return back == text.replace(MARK, " ")


def decode_ids(encoded: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``token_ids`` (null for null)."""
    shared = load_model(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, _ = _codec(shared.value)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def encode_digests(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: n_tokens, the digest of the ids as little-endian 32-bit
    numbers, the digest of the decoded text, round_trip and parity; see ``encode_texts``."""
    shared = load_model(docs.sparkSession, path)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, processor = _codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [t or "" for t in part.column("text").to_pylist()]
                rows = [(len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), _same_text(codec, t, text), same) for t, (ids, text, same) in zip(own, codec.encode(own, processor))]
                kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity"])

    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean")
