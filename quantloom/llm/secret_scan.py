"""Secret scans with a recursive decoding worklist.

A document's text is the first layer. Every layer is scanned; the layer without its URL escapes,
that without its Unicode escapes, and stretches of base64, at each of the four places where one may begin, and compressed
data are further layers until nothing new appears. An escaped escape sign is unwrapped with what it escapes, however often.
Each layer knows the stretch of the text around it that any of its stretches came from.
"""

from __future__ import annotations

import base64
import codecs
import copy
import hashlib
import re
import sys
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
PIECE = 1 << 18  # bytes of decompressed data that are taken at once: a bound on memory against decompression bombs
READABLE = 0.8  # a layer is counted if this share of its characters can be printed; every layer is scanned
REDACTED = "[SECRET]"

_FLAGS = re.ASCII
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS | re.IGNORECASE)
_KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", _FLAGS | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+", _FLAGS)
_HEX = re.compile(r"[0-9a-f]{24,}", _FLAGS)  # maximal runs, so the same as runs of any length of which the short ones are dropped
_WORDS = ("pass", "secret", "token", "api")
_UNICODE = re.compile(r"\\(?:u005[Cc]|x5[Cc])*(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2}))", _FLAGS)
_PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+", _FLAGS)
_OCTET = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})", _FLAGS)
_ESCAPE = re.compile(_UNICODE.pattern + "|" + _PERCENT.pattern, _FLAGS)
_SPACES = re.compile(r"\x20{5,}")
_SEXTETS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_STRETCH = re.compile(r"[A-Za-z0-9+/_-]+", _FLAGS)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}", _FLAGS)
# base64 broken into lines; it starts where a stretch does and gives nothing back, so long stretches take linear time
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\x20*+\r?\n\x20*+)+[A-Za-z0-9+/_-]+={0,2}", _FLAGS)

Span = tuple[int, int, int]
Place = Callable[[int, int], tuple[int, int]]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the secrets that stand in ``text`` as it is, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _layer_spans(text: str) -> set[Span]:
    """The base spans, and those of keywords that end another one's value ('secret: password: x')."""
    spans, at = set(base_spans(text)), 0
    while m := _ASSIGN.search(text, at):
        if len(m[2]) >= 6:
            spans.add((m.start(), 0, m.end()))
        at = max((k.start() for k in _KEYWORD.finditer(text, *m.span(2))), default=m.end())
    return spans


def _compressed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0)


def _readable(text: str) -> bool:
    return 0 < READABLE * len(text) <= sum(c.isprintable() and c != "\ufffd" or c in "\t\n\r" for c in text)


def _unescaped(text: str, one: re.Pattern, read) -> tuple[str, Place]:
    out, starts, stops, origins, last, size = [], [], [], [], 0, 0
    for m in one.finditer(text):
        new = read(m)
        out += [text[last : m.start()], new]
        size += m.start() - last
        starts.append(size)
        size += len(new)
        stops.append(size)
        origins.append(m.span())
        last = m.end()

    def origin(i: int) -> tuple[int, int]:
        j = bisect_right(starts, i) - 1
        if j < 0:
            return i, i + 1
        at = origins[j][1] + i - stops[j]
        return origins[j] if i < stops[j] else (at, at + 1)

    return "".join(out) + text[last:], lambda a, b: (origin(a)[0], origin(b - 1)[1])


def _percent(m: re.Match) -> str:
    return bytes.fromhex("".join(_OCTET.findall(m[0]))).decode("utf-8", "replace")


def _code_point(m: re.Match) -> str:
    return chr(int(m[1] or m[2], 16))


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogateescape"))


class Packed(NamedTuple):
    """A stretch of base64 that holds compressed data, and its place."""

    stretch: str
    start: int
    end: int


def _unwrapped(text: str) -> Iterator[tuple[str | Packed, Place]]:
    """(decoded text, the stretch of ``text`` that a stretch of it comes from) for the whole layer without its escapes, and for each encoded stretch.

    A stretch of compressed data is given as it is: all in it has the same place.
    """
    for sign, one, read in (("%", _PERCENT, _percent), ("\\", _UNICODE, _code_point)):
        if sign in text and one.search(text):
            yield _unescaped(text, one, read)
    for m in _BASE64.finditer(text):
        for first in range(4):  # what stands before may be part of the stretch, as in a path
            yield from _decoded(m[0][first:], range(m.start() + first, m.end()))
    for m in _LINES.finditer(text):
        places = [i for i in range(m.start(), m.end()) if text[i] not in " \r\n"]
        for first in range(4):
            yield from _decoded("".join(text[i] for i in places[first:]), places[first:])


def _decoded(stretch: str, places) -> Iterator[tuple[str | Packed, Place]]:
    """What a stretch of base64 holds; ``places`` are those of its characters."""
    body = stretch.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]  # six bits are no byte
    data = base64.b64decode(body + "=" * (-len(body) % 4))
    if _compressed(data):
        whole = (places[0], places[-1] + 1)
        yield Packed(stretch.rstrip("="), *whole), lambda a, b: whole
    # each character has its own sextets; compressed data may also be text that only begins like it
    new = data.decode("utf-8", "surrogateescape")
    yield new, lambda a, b: (places[_size(new[:a]) * 8 // 6], places[min(len(places), -(-_size(new[:b]) * 8 // 6)) - 1] + 1)


class _Decoder:
    """A stretch of base64 inside compressed data, or the compressed data's own, which comes in pieces."""

    def __init__(self, found: list, around: frozenset):
        self.found, self.around = found, around
        self.chars, self.long, self.head, self.packed, self.inflate, self.layer = "", False, b"", None, None, None
        self.codec = codecs.getincrementaldecoder("utf-8")("replace")

    def clone(self) -> _Decoder:
        new = copy.copy(self)
        new.codec = codecs.getincrementaldecoder("utf-8")("replace")
        new.codec.setstate(self.codec.getstate())
        new.inflate, new.layer = self.inflate and self.inflate.copy(), self.layer and self.layer.clone()
        return new

    def feed(self, chars: str) -> None:
        self.chars += chars.replace("-", "+").replace("_", "/")
        self.long = self.long or len(self.chars) >= 16
        if self.long:
            n = len(self.chars) // 4 * 4
            data, self.chars = base64.b64decode(self.chars[:n]), self.chars[n:]
            self._bytes(data)

    def _bytes(self, data: bytes) -> None:
        while data and self.packed != "broken":
            if self.inflate is None and self.packed != "no":
                data = self.head + data
                if len(data) < 3:
                    self.head = data
                    return
                self.head = b""
                if _compressed(data):  # also the next member of a gzip file
                    self.inflate, self.packed = zlib.decompressobj(wbits=47), "yes"
                else:
                    self.packed = "broken" if self.packed else "no"
            elif self.packed == "no":
                self._text(self.codec.decode(data))
                return
            else:
                try:
                    out = self.inflate.decompress(data, PIECE)
                    while out:
                        self._text(self.codec.decode(out))
                        out = self.inflate.decompress(self.inflate.unconsumed_tail, PIECE)
                except zlib.error:
                    self.packed = "broken"
                    return
                data = self.inflate.unused_data
                if self.inflate.eof:
                    self.inflate = None

    def _text(self, text: str) -> None:
        if self.layer is None:
            self.found[1] += _readable(text)
            self.layer = _Layer(self.found, self.around)
        self.layer.feed(text)

    def close(self) -> None:
        if self.long and len(self.chars) > 1:
            self._bytes(base64.b64decode(self.chars + "=" * (-len(self.chars) % 4)))
        if self.layer is not None:
            self.layer.close()


class _Layer:
    """A layer inside compressed data, which comes in pieces; all of it has the same place, so only kinds are kept.

    What is open at the end of a piece goes on in the next one: a tail for the patterns, a stretch of base64, a
    started escape. Runs of spaces are shortened, so a tail of fixed size is enough. Escapes of all kinds are taken at once.
    """

    def __init__(self, found: list, around: frozenset):
        self.found, self.around = found, around  # [kinds, number of layers]; stretches that the layer stands in
        self.tail, self.rest, self.open, self.inner = "", "", None, None

    def clone(self) -> _Layer:
        new = copy.copy(self)
        new.open, new.inner = self.open and self.open.clone(), self.inner and self.inner.clone()
        return new

    def feed(self, text: str, last: bool = False) -> None:
        text, self.rest = self.rest + text, ""
        if not last:
            cut = len(text.rstrip(_SEXTETS))
            cut -= text[:cut].endswith(("%", "\\"))
            if len(text) - cut > PIECE:  # too long a stretch to wait for its end
                cut = len(text) - 6
            text, self.rest = text[:cut], text[cut:]
        if self.inner is None and _ESCAPE.search(text):
            self.found[1] += 1
            self.inner = self.clone()  # so far the same without escapes
            self.inner.rest = ""
        if self.inner is not None:
            self.inner.feed(_ESCAPE.sub(lambda m: _percent(m) if m[0][0] == "%" else _code_point(m), text))
        look = _SPACES.sub(" " * 4, self.tail + text)
        self.found[0].update(kind for _, kind, _ in _layer_spans(look))
        self.tail = look[-128:]
        for m in _STRETCH.finditer(text):
            if m.start() == 0 and self.open is not None:
                run = self.open
            elif len(m[0]) < 16 and m.end() < len(text) or m[0] in self.around:
                continue
            else:
                run = _Decoder(self.found, self.around | {m[0]})
            if self.open is not None and run is not self.open:
                self.open.close()
            self.open = run
            run.feed(m[0])
        if self.open is not None and text and text[-1] not in _SEXTETS:
            self.open.close()
            self.open = None

    def close(self) -> None:
        self.feed("", last=True)
        if self.open is not None:
            self.open.close()
        if self.inner is not None:
            self.inner.close()


def _inside(stretch: str) -> tuple[frozenset[int], int]:
    """Kinds of the secrets inside a base64 stretch of compressed data, and the number of layers there."""
    found = [set(), 0]
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 100_000))  # a call or two a layer
    decoder = _Decoder(found, frozenset([stretch]))
    decoder.feed(stretch)
    decoder.close()
    return frozenset(found[0]), found[1]


def all_spans(text: str, base: list[Span]) -> tuple[list[Span], int]:
    """All spans on the original text, the base ones included, and the number of different unwrapped layers.

    The spans of a decoded text are found once, by its own places, and laid on every stretch that decodes to it.
    A text that stands inside itself is not unwrapped there again, so cycles end.
    """
    known: dict[str, set[Span]] = {}
    packed: dict[str, tuple[frozenset[int], int]] = {}
    met: set[str] = set()
    # a layer being worked on: text, spans, inner layers left, its places in the layer around it, outermost layer met again inside
    chain = [[text, set(base), _unwrapped(text), None, 0]]
    depths = {text: 0}  # of the layers in the chain
    while True:
        depth = len(chain) - 1
        layer, spans, inner, place, _ = chain[-1]
        for new, where in inner:
            if isinstance(new, Packed):
                if new.stretch not in packed:
                    packed[new.stretch] = _inside(new.stretch)
                spans |= {(new.start, kind, new.end) for kind in packed[new.stretch][0]}
                continue
            if new not in met and _readable(new):
                met.add(new)
            if new in depths:
                chain[-1][4] = min(chain[-1][4], depths[new])
            elif new in known:
                spans |= _laid(known[new], where)
            else:
                depths[new] = depth + 1
                chain.append([new, _layer_spans(new), _unwrapped(new), where, depth + 1])
                break
        else:
            if depth == 0:
                return sorted(spans), len(met - {text}) + sum(n for _, n in packed.values())
            outermost = chain.pop()[4]
            del depths[layer]
            if outermost == depth:
                known[layer] = spans
            else:  # what was left out here depends on the layers around it
                chain[-1][4] = min(chain[-1][4], outermost)
            chain[-1][1] |= _laid(spans, place)


def _laid(spans: set[Span], place: Place) -> set[Span]:
    return {(at[0], kind, at[1]) for start, kind, end in spans for at in [place(start, end)]}


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            spans, layers = all_spans(text or "", base)
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), layers))
        columns = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64())] + [pa.array(x, t) for x, t in zip(columns, kinds)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers"])


def secret_scan(docs: DataFrame) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: counts of base secrets by kind, the digest of the base
    spans, all spans, and the number of layers that were unwrapped.

    A null text counts as empty and has no spans. Rows are independent: repeated rows give repeated
    results, an empty table gives none, other columns are ignored. Texts and all layers are scanned whole;
    compressed data in pieces, so its size bounds time only.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long")


def redacted(text: str) -> str:
    """``text`` with every span, merged where they overlap, replaced by a mark."""
    out, last, begin, end = [], 0, 0, -1
    for start, _, stop in all_spans(text, base_spans(text))[0]:
        if start >= end:
            if end >= 0:
                out += [text[last:begin], REDACTED]
                last = end
            begin = start
        end = max(end, stop)
    if end >= 0:
        out += [text[last:begin], REDACTED]
        last = end
    return "".join(out) + text[last:]


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets cut out of ``text`` (null stays null) and ``n_chars`` set to the new length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("text")
            texts = [t if t is None else redacted(t) for t in batch.column(i).to_pylist()]
            batch = batch.set_column(i, "text", pa.array(texts, pa.string()))
            j = batch.schema.get_field_index("n_chars")
            if j >= 0:
                counts = [k if t is None else len(t) for t, k in zip(texts, batch.column(j).to_pylist())]
                batch = batch.set_column(j, batch.schema.field(j), pa.array(counts, batch.schema.field(j).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
