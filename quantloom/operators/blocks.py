"""Blocks: tables with a row for some tens of thousands of rows, whose columns are packed.

A block is small on disk, is read as often as needed without a shuffle, and its columns are numpy arrays at once. A table of
blocks has ``block`` (a number of its own), ``n`` (its rows) and ``data`` (packed columns); a ``Read`` takes such a row and names
and returns the columns of these names as floats, NaN for null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

Read = Callable[[Mapping, Sequence[str]], dict[str, np.ndarray]]
BLOCKS = "block long, n long, data array<binary>"


def pack(x: np.ndarray) -> bytes:
    """Entries of eight bytes, byte by byte of all of them, compressed."""
    return pa.compress(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def unpack(data: bytes, n: int, kind: type = np.float64) -> np.ndarray:
    """The ``n`` entries that were packed."""
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def numbers() -> Iterator[int]:
    """Numbers that no other task gives."""
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so one block at a time is in use."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def record(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def packed(df: DataFrame, columns: Mapping[str, Column]) -> tuple[DataFrame, Read]:
    """``columns`` of ``df`` as doubles in blocks, and how to read them."""
    schema, place = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("data", pa.list_(pa.binary()))]), {c: i for i, c in enumerate(columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in zip(numbers(), batches):
            if batch.num_rows:
                yield record([(number, batch.num_rows, [pack(c.to_numpy(zero_copy_only=False).astype(np.float64)) for c in batch.columns])], schema)

    def read(row: Mapping, names: Sequence[str]) -> dict[str, np.ndarray]:
        return {c: unpack(row["data"][place[c]], row["n"]) for c in names}

    values = [c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())]
    return df.select(*values).mapInArrow(run, BLOCKS), read
