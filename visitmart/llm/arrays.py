"""Array helpers shared by the operators' task-side code (numpy and Arrow only).

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. A word's hash is the
sum of its mixed 8-byte chunks (no polynomial, so no built word has a known
partner); a window's hash is a polynomial over its words' hashes. A whole batch
of texts is hashed with a few array operations.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P1, _P2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_CHUNK_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(max(n, 1 << 16), b, U64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        have = _powers[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 row offsets (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = 1 << 21):
    """Row ranges of about ``limit`` bytes each (a longer row comes alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def release() -> None:
    """Hand memory freed by the last batch back to the system: workers live on
    into later stages, beside an executor's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):                          # not glibc
        pass


def releasing(run):
    """``run``, a map over record batches, with a release once its last batch is
    gone: the worker then waits beside later stages without it."""

    def released(batches):
        yield from run(batches)
        release()

    return released


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0, block: int = 1 << 14) -> np.ndarray:
    """A 64-bit hash of the bytes of each span of a buffer; another ``seed`` gives
    an independent one. Spans are hashed ``block`` at a time."""
    out = np.empty(len(start), U64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))      # the 8 bytes from each place on
    salt = mix64(np.array([seed], U64))[0]
    for a in range(0, len(start), block):
        at, size = start[a:a + block], end[a:a + block] - start[a:a + block]
        part = mix64(((eight[at] & _CHUNK_MASK.take(size, mode="clip")) + salt) * U64(_P1) ^ U64(_P2))
        more = np.flatnonzero(size > 8)                                # the chunks after the first
        if len(more):
            n = (size[more] - 1) >> 3
            first = np.cumsum(n) - n
            k = np.arange(1, int(n.sum()) + 1, dtype=np.int64) - np.repeat(first, n)
            left = np.repeat(size[more], n) - 8 * k
            chunk = eight[np.repeat(at[more], n) + 8 * k] & _CHUNK_MASK.take(left, mode="clip")
            part[more] += np.add.reduceat(mix64((chunk + salt) * U64(_P1) ^ (k.astype(U64) + U64(1)) * U64(_P2)), first)
        out[a:a + block] = mix64(part + size.astype(U64) * U64(_P1))
    return out


class Words:
    """Words of consecutive rows: byte spans, hashes, and each row's range."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        offsets = offsets - offsets[0]
        self.raw = raw
        inside = ~IS_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        if len(raw):
            edge[0] = inside[0]
            edge[1:-1] = inside[1:] != inside[:-1]
            edge[-1] = inside[-1]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(raw))]
            cuts = cuts[inside[cuts] & inside[cuts - 1]]     # a word never crosses rows
        else:
            cuts = offsets[:0]
        at = np.flatnonzero(edge)
        if len(cuts):
            at = np.sort(np.concatenate([at, np.repeat(np.unique(cuts), 2)]))
        self.start, self.end = at[0::2], at[1::2]
        self.row_start = np.searchsorted(self.start, offsets[:-1])
        self.row_end = np.append(self.row_start[1:], len(self.start)) if len(self.row_start) else self.row_start
        self.counts = self.row_end - self.row_start

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.raw, self.start, self.end, seed)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of words[i:i+n] for each i (windows that cross rows included)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    p, q = powers(_P2, len(words) + 1)
    h = np.zeros(len(words) + 1, U64)
    np.cumsum(words * p[:-1], dtype=U64, out=h[1:])
    return mix64((h[n:] - h[:m]) * q[:m])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated integer ranges [start, start+length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, lengths)


GRAM = 0x9E3779B97F4A7C15
GRAM_OF = {n: 0xA0761D6478BD642F * (2 * n + 1) % 2**64 for n in range(1, 9)}


def ngrams(raw: np.ndarray, offsets: np.ndarray, sizes: tuple, bits: int):
    """Hashed character n-grams (bytes, A-Z lowered) that lie in one word, bounding
    blanks included. For each n a pair: the bucket of the n-gram that starts at
    byte i, and whether there is one. Rows are separated by a blank, and the
    second result gives where each row starts. n is 2 to 8, in rising order."""
    n_rows = len(offsets) - 1
    m = len(raw) + n_rows
    b = np.full(m + 8, 32, np.uint8)
    b[np.arange(len(raw)) + np.repeat(np.arange(1, n_rows + 1), np.diff(offsets))] = np.where(IS_SPACE[raw], 32, LOWER[raw])
    blank = b == 32
    count = np.cumsum(blank, dtype=np.int32)
    v = np.zeros(m, U64)
    out, j = [], 0
    for n in sizes:
        while j < n:
            v |= b[j:j + m].astype(U64) << U64(8 * j)
            j += 1
        ok = (count[n - 2:n - 2 + m] == count[:m]) & ~(blank[:m] & blank[1:m + 1])
        out.append((((v ^ U64(GRAM_OF[n])) * U64(GRAM) >> U64(64 - bits)).astype(np.int32), ok))
    return out, offsets[:-1] + np.arange(n_rows)
