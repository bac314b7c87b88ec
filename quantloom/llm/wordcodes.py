"""Vectorised word hashing for the Arrow batches that Spark hands to a task.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D`` of the UTF-8 text, with A-Z lowered.
Each word gets a 64-bit code, and the codes of a sequence of words combine into shingle codes.
Everything here works on one bounded block of rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_rng = np.random.default_rng(0x5EED)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
for _upper in range(ord("A"), ord("Z") + 1):
    _BYTES[_upper] = _BYTES[_upper + 32]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_STEPS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = np.full(max(n, BLOCK_BYTES), _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind]


class Words(NamedTuple):
    """The words of some rows: ``offsets[i]:offsets[i + 1]`` are those of row i; bytes are block-relative."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    total: np.ndarray

    def heads(self, size: int) -> np.ndarray:
        """Codes of the words' first ``size`` bytes (of the whole word, if shorter)."""
        stops = np.minimum(self.starts + size, self.ends)
        return mix((self.total[stops] - self.total[self.starts]) * _power("down", len(self.total))[self.starts])

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words_of(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = _SPACE) -> Words:
    """Words of the rows ``data[bounds[i]:bounds[i + 1]]`` (UTF-8 bytes); no word crosses a row's end.

    ``space`` tells for each byte whether it separates words.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(bounds), np.int64), np.zeros(1, np.uint64))
    solid = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[data] * _power("up", n)[:n], out=total[1:])
    codes = mix((total[ends] - total[starts]) * _power("down", n)[starts])
    return Words(codes, starts, ends, np.searchsorted(starts, bounds), total)


def shingle_codes(codes: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Codes of all runs of ``width`` words; of the whole sequence if it is shorter (none if empty)."""
    n = len(codes)
    if n == 0:
        return codes
    k = min(width, n)
    total = codes[: n - k + 1] * _STEPS[0]
    for i in range(1, k):
        total = total + codes[i : n - k + 1 + i] * _STEPS[i]
    return mix(total + np.uint64(k))


def row_shingles(words: Words, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct shingle codes (see ``shingle_codes``)."""
    codes, offsets = words.codes, words.offsets
    n = len(codes)
    total = np.zeros(0, np.uint64)
    if n >= width:
        total = codes[: n - width + 1] * _STEPS[0]
        for i in range(1, width):
            total += codes[i : n - width + 1 + i] * _STEPS[i]
        total = mix(total + np.uint64(width))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            own = np.sort(total[a : b - width + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            yield own
        else:
            yield shingle_codes(codes[a:b], width)


def set_code(shingles: np.ndarray) -> int:
    """A signed 64-bit code of a sorted set of codes."""
    folded = np.array([np.bitwise_xor.reduce(mix(shingles + np.uint64(1))), len(shingles)], np.uint64)
    return int(mix(folded[:1] + folded[1:] * _STEPS[7]).view(np.int64)[0])


def text_blocks(column: pa.Array | pa.ChunkedArray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks ``(first row, bytes, bounds)`` of a text column; null counts as empty.

    A block has whole rows and about ``block_bytes`` at most, unless one row alone is longer.
    """
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        chunk = pc.fill_null(chunk.cast(pa.large_string()), "")
        if len(chunk) == 0:
            continue
        offsets = np.frombuffer(chunk.buffers()[1], np.int64, len(chunk) + 1, chunk.offset * 8)
        raw = chunk.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(chunk):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block_bytes, "right")) - 1)
            j = min(j, len(chunk))
            yield row + i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j
        row += len(chunk)
