"""Integer columns packed into rows of bytes, so that a shuffle moves few large rows instead of many small ones.

A task collects entries with a bucket number and writes, each ``LIMIT`` entries, one row a bucket: the columns one after the other,
each as byte planes (all lowest bytes, then the next ...), which compress well.  ``exchange`` gives every bucket a partition of its own,
so what a task reads depends on the entries of a bucket alone, whatever the size of the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Entries a task collects before it writes them; ``PIECE``: entries of one row at most.
LIMIT, PIECE = 1_000_000, 1 << 16
SCHEMA = "bucket int, n int, data binary"


def labels(buckets: int) -> np.ndarray:
    """For every bucket a number that Spark's hash partitioning (Murmur3 of an int, seed 42) puts into the partition of the bucket's own number."""
    u = np.uint32
    rotl = lambda x, r: (x << u(r)) | (x >> u(32 - r))
    names = np.arange(64 * buckets + 64, dtype=u)
    h = rotl(names * u(0xCC9E2D51), 15) * u(0x1B873593) ^ u(42)
    h = rotl(h, 13) * u(5) + u(0xE6546B64)
    h ^= u(4)
    h = (h ^ (h >> u(16))) * u(0x85EBCA6B)
    h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
    h = (h ^ (h >> u(16))).view(np.int32).astype(np.int64)
    own, first = np.unique(h % buckets, return_index=True)
    out = np.arange(buckets, dtype=np.int32) + np.int32(len(names))  # a bucket that none of so many names meets shares a partition
    out[own] = names[first].astype(np.int32)
    return out


class Packer:
    """Collects columns of the given types and yields packed batches."""

    def __init__(self, buckets: int, *types: type):
        self.labels, self.types = labels(buckets), [np.dtype(t) for t in types]
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, key: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Add entries of which ``key`` (a mixed 64-bit hash) chooses the bucket."""
        if len(key):
            bucket = self.labels[(key % np.uint64(len(self.labels))).astype(np.int64)]
            self.parts.append((bucket, *(c.astype(t, copy=False) for c, t in zip(columns, self.types, strict=True))))
            self.held += len(key)
            if self.held >= LIMIT:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        bucket, *columns = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        columns = [c[order] for c in columns]
        cuts = np.unique(np.concatenate((np.flatnonzero(np.diff(bucket, prepend=-1)), np.arange(0, len(bucket), PIECE), [len(bucket)]))).tolist()
        names, sizes, data = [], [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            names.append(bucket[lo])
            sizes.append(hi - lo)
            data.append(b"".join(c[lo:hi].view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in columns))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "n", "data"])


def unpack(n: int, data: bytes, types: tuple) -> list[np.ndarray]:
    out, at = [], 0
    for t in map(np.dtype, types):
        planes = np.frombuffer(data, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += n * t.itemsize
    return out


def exchange(packed: DataFrame, buckets: int) -> DataFrame:
    """A partition for every bucket; should two share one, they come one after the other."""
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def buckets_of(batches, *types: type) -> Iterator[list[np.ndarray]]:
    """The entries of each bucket of an exchanged partition."""
    held: list[list[np.ndarray]] = []
    now = None
    for batch in batches:
        for bucket, n, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != now and held:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            now = bucket
            held.append(unpack(n, data, types))
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]
