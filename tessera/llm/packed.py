"""Packed exchanges: arrays of many records in one row, dealt by bucket and met there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

SCHEMA = "kind int, bucket int, payload binary"
_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
#: Bytes of text that a bucket is meant to hold.
BUCKET_BYTES = 8 << 20


def dump(arrays: list[np.ndarray], raw: bytes | None = None) -> bytes:
    """Equally long arrays and an optional compressed tail."""
    n = len(arrays[0])
    parts = [np.array([n], "<u8").tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]
    if raw is not None:
        parts.append(zstandard.ZstdCompressor(level=1).compress(raw))
    return b"".join(parts)


def load(payload: bytes, types: tuple) -> tuple[list[np.ndarray], memoryview]:
    n, at, out = int(np.frombuffer(payload, "<u8", 1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(payload, t, n, at))
        at += n * np.dtype(t).itemsize
    return out, memoryview(payload)[at:]


def unzip(tail: memoryview) -> bytes:
    return zstandard.ZstdDecompressor().decompress(tail)


def joined(payloads: list[bytes], types: tuple) -> list[np.ndarray]:
    """The arrays of several payloads end to end."""
    loaded = [load(p, types)[0] for p in payloads]
    return [np.concatenate([x[i] for x in loaded]) if loaded else np.zeros(0, t) for i, t in enumerate(types)]


def split_by(bucket: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(bucket, its part of every array) in ascending order, records in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
    arrays = [a[order] for a in arrays]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(own[a]), [x[a:b] for x in arrays]


def batches_of(rows: Iterator[tuple[int, int, bytes]], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def meet(rows: DataFrame, work: Callable[[int, dict[int, list[bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """work(bucket, payloads by kind) for every bucket, one bucket in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, {}
        for batch in batches:
            for kind, b, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if held:
                        yield from work(bucket, held)
                    bucket, held = b, {}
                held.setdefault(kind, []).append(payload)
        if held:
            yield from work(bucket, held)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)
