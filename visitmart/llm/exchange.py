"""Questions from chunks of rows to buckets of hashes, and answers back.

A chunk (a few MB of rows) reduces its hashes to distinct records, sorted, and
sends each bucket one packed row; the bucket sees the records of all chunks and
returns one bit (or byte) per record in the order they were sent. A chunk can
rebuild its records at any time, so nothing else has to travel back, and a hash
that a third of all rows share is one record per chunk, not one per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64

ASK = "bucket int, chunk int, n long, payload binary"
ANSWER = "chunk int, bucket int, bits binary"
CHUNK = 2 << 20


def planes(values: np.ndarray) -> bytes:
    """Values as byte planes; planes of small numbers are mostly zeros and compress."""
    v = np.ascontiguousarray(values)
    return v.view(np.uint8).reshape(len(v), v.itemsize).T.tobytes()


def from_planes(data: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8, n * size).reshape(size, n).T.copy().view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, n: int, dtype) -> np.ndarray:
    return np.cumsum(from_planes(data, n, dtype), dtype=dtype)


def plan(docs: DataFrame, text: str = "text", least: int = CHUNK, most: int = CHUNK, chunks_per_bucket: int = 8):
    """(number of chunks, number of buckets) for the bytes of all texts. A chunk is
    as large at 30 GB as at 30 MB, and a bucket sees at most ``chunks_per_bucket``
    of them, so that a task's memory does not grow with the input."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    chunks = max(1, -(-total // min(most, max(least, total // 256))))
    return chunks, -(-chunks // chunks_per_bucket)


def split_buckets(bucket: np.ndarray, n_buckets: int):
    """(bucket, from, to) of each run of a sorted bucket array."""
    present = np.unique(bucket)
    return zip(present.tolist(), np.searchsorted(bucket, present).tolist(), np.searchsorted(bucket, present, "right").tolist())


def ask_table(chunk: int, rows: list) -> pa.Table:
    """rows: (bucket, n, payload)."""
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()),
                     "n": pa.array([r[1] for r in rows], pa.int64()), "payload": pa.array([r[2] for r in rows], pa.binary())})


def answer_table(asked: pa.Table, flags: np.ndarray) -> pa.Table:
    """One bit per record, split as the asking rows were."""
    n = asked["n"].to_numpy()
    cut = np.cumsum(n)[:-1]
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"],
                     "bits": pa.array([np.packbits(x).tobytes() for x in np.split(flags, cut)], pa.binary())})


def answers(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table["bucket"].to_pylist(), table["bits"].to_pylist()))


def read_flags(got: dict[int, bytes], bucket: np.ndarray, n_buckets: int) -> np.ndarray:
    """The flags of all records, in the order of the sorted bucket array."""
    out = np.zeros(len(bucket), bool)
    for b, a, z in split_buckets(bucket, n_buckets):
        out[a:z] = np.unpackbits(np.frombuffer(got[b], np.uint8), count=z - a).astype(bool)
    return out


def sort_with_index(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    return values[order], order


def low_bucket(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """A bucket from the low half of a hash."""
    return ((h & U64(0xFFFFFFFF)) * U64(n_buckets)) >> U64(32)
