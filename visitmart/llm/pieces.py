"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is cut into units (blanks and the run of other characters after them;
no piece of the vocabulary crosses a unit's border). In a unit the agenda holds
every adjacent pair whose concatenation is a piece; the best score goes first,
the leftmost of equals. Each candidate is skipped when a keyed hash of (seed,
document, place of the unit, start, piece) falls below the dropout rate: every
occurrence of a word is drawn for itself, and the same seed always gives the same
segmentation. A document is its key, its text and, where rows repeat, the number
of the copy. With rate 0 the result is SentencePiece's own.

Whatever was skipped, the pieces still spell the unit, so decoding is exact.
Two things SentencePiece itself loses are kept: a literal U+2581 is encoded by
its bytes, and the blank put before each text is taken off again by count.

The units of a slice are merged together, one agenda step for all of them at a
time (with rate 0 each distinct unit once); long units run through a heap instead.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix64, ranges, release, releasing, slices, span_hashes, text_buffer

MARK = "▁"
PAD = -1
MATRIX_LIMIT = 48                     # longer units go through the heap
SLICE = 1 << 19                       # bytes of text merged together; a slice's arrays take about 100 times that
_K1, _K2 = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size, self.byte_id = n, np.full(256, PAD, np.int64)
        text = [sp.id_to_piece(i) for i in range(n)]
        normal = {}
        self.raw = []
        for i, t in enumerate(text):
            if sp.is_byte(i):
                self.byte_id[int(t[1:-1], 16)] = i
                self.raw.append(bytes([int(t[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                normal[t] = i
                self.raw.append(t.replace(MARK, " ").encode())
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        chars = sorted({c for t in normal for c in t} - normal.keys())
        symbol = normal | {c: n + k for k, c in enumerate(chars)}        # characters only found inside pieces
        self.base = n + len(chars)                                       # base + code point: any other character
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + np.int32(self.base)
        for t, i in symbol.items():
            if len(t) == 1:
                self.symbol_of[ord(t)] = i
        self.char_of = dict((n + k, c) for k, c in enumerate(chars))
        self.symbol_of[32], self.symbol_of[ord(MARK)] = symbol[MARK], self.base + ord(MARK)
        pairs = [(symbol[t[:k]], symbol[t[k:]], i, -sp.get_score(i)) for t, i in normal.items()
                 for k in range(1, len(t)) if t[:k] in symbol and t[k:] in symbol]
        self._fill(pairs)
        self._pairs, self._pair = pairs, None
        self.breaks = not any("\n" in t for t in normal if len(t) > 1)
        if any(a != MARK and b == MARK for t in normal for a, b in zip(t, t[1:])):
            raise ValueError("a piece crosses the border before a blank")

    def _fill(self, pairs):
        """Open-addressing table of the pairs, probed for whole arrays at once."""
        self.bits = max(4, (len(pairs) * 6).bit_length())
        size = 1 << self.bits
        self.key, self.merged = np.full(size, PAD, np.int64), np.zeros(size, np.int32)
        self.cost = np.zeros(size, np.float32)
        a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        for slot, key, (_, _, i, c) in zip(self._slot(a, b).tolist(), ((a << 32) | b).tolist(), pairs):
            while self.key[slot] != PAD:
                slot = (slot + 1) % size
            self.key[slot], self.merged[slot], self.cost[slot] = key, i, c

    @property
    def pair(self) -> dict:
        """(left, right) -> (cost, piece), for the heap; made when a long unit comes."""
        if self._pair is None:
            self._pair = {(a, b): (c, i) for a, b, i, c in self._pairs}
        return self._pair

    def _slot(self, a, b):
        return ((a.astype(U64) * _K1 + b.astype(U64) * _K2) >> U64(64 - self.bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray):
        """(cost, merged piece) of each pair; cost inf where they do not merge."""
        key, slot = (a.astype(np.int64) << 32) | b, self._slot(a, b)
        found = self.key[slot]
        open_ = np.flatnonzero((found != key) & (found != PAD))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.key[slot[open_]]
            open_ = open_[(found[open_] != key[open_]) & (found[open_] != PAD)]
        hit = (found == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.cost[slot], np.float32(np.inf)), np.where(hit, self.merged[slot], 0)


def skipped(key: np.ndarray, start: np.ndarray, piece: np.ndarray, rate: float) -> np.ndarray:
    """Keyed hash of a candidate against the dropout rate."""
    if rate <= 0:
        return np.zeros(np.broadcast(key, start).shape, bool)
    h = mix64(key + start.astype(U64) * _K1 + piece.astype(U64) * _K2)
    return (h >> U64(11)).astype(np.float64) < rate * 2.0 ** 53


def merge_heap(v: Pieces, symbols: list[int], key: int, rate: float) -> list[int]:
    """One unit through a heap of candidates; stale entries are dropped when met."""
    sym, left, right = list(symbols), list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    heap: list = []

    def propose(i, j):
        got = v.pair.get((sym[i], sym[j]))
        if got and not skipped(np.array([key], U64), np.array([i]), np.array([got[1]]), rate)[0]:
            heapq.heappush(heap, (got[0], i, sym[i], j, sym[j], got[1]))

    for i in range(len(sym) - 1):
        propose(i, i + 1)
    while heap:
        _, i, a, j, b, piece = heapq.heappop(heap)
        if sym[i] != a or j >= len(sym) or sym[j] != b or right[i] != j:
            continue
        sym[i], sym[j], right[i] = piece, None, right[j]
        if right[i] < len(sym):
            left[right[i]] = i
            propose(i, right[i])
        if left[i] >= 0:
            propose(left[i], i)
    return [s for s in sym if s is not None]


def merge_matrix(v: Pieces, sym: np.ndarray, key: np.ndarray, rate: float) -> np.ndarray:
    """Units as the rows of a padded matrix; each step merges one pair in every
    row. Symbols are linked to their live neighbours; a merged one becomes PAD."""
    n, width = sym.shape
    w = width + 1                                                   # a last column that never merges
    s = np.full((n, w), PAD, np.int32)
    s[:, :-1] = sym
    right = np.tile(np.arange(1, w + 1, dtype=np.int16), (n, 1)).ravel()
    left = np.tile(np.arange(-1, w - 1, dtype=np.int16), (n, 1)).ravel()
    cost, piece = np.full((n, w), np.inf, np.float32), np.zeros(n * w, np.int32)

    def candidates(a, b, col, k):
        c, p = v.lookup(a, b)
        live = np.flatnonzero(np.isfinite(c))
        if rate > 0:
            c[live[skipped(k[live], col[live], p[live], rate)]] = np.inf
        return c, p

    if width > 1:
        c, p = candidates(s[:, :-2].ravel(), s[:, 1:-1].ravel(), np.tile(np.arange(width - 1), n), np.repeat(key, width - 1))
        cost[:, :width - 1], piece.reshape(n, w)[:, :width - 1] = c.reshape(n, -1), p.reshape(n, -1)
    s, rows = s.ravel(), np.arange(n)
    while len(rows):
        best = cost.argmin(1)
        live = np.isfinite(cost[np.arange(len(rows)), best])
        if not live.all():
            cost, rows, best = cost[live], rows[live], best[live]
        if not len(rows):
            break
        base, here = rows * w, np.arange(len(rows)) * w
        j = base + best
        gone = right[j]
        k = base + gone
        s[j], s[k] = piece[j], PAD
        after = right[k]
        right[j], left[base + after] = after, best
        flat = cost.ravel()
        flat[here + gone] = np.inf
        before = left[j].astype(np.int64)
        has = np.flatnonzero(before >= 0)
        bj = base[has] + before[has]
        c, p = candidates(np.concatenate([s[j], s[bj]]), np.concatenate([s[base + after], s[j[has]]]),
                          np.concatenate([best, before[has]]), np.concatenate([key[rows], key[rows[has]]]))
        m = len(rows)
        flat[here + best], piece[j] = c[:m], p[:m]
        flat[here[has] + before[has]], piece[bj] = c[m:], p[m:]
    return s.reshape(n, w)[:, :-1]


def merge_units(v: Pieces, symbols: np.ndarray, length: np.ndarray, key: np.ndarray, rate: float):
    """Flat symbols of consecutive units -> flat symbols after merging, and lengths."""
    first = np.cumsum(length) - length
    order = np.argsort(length, kind="stable")
    sizes = np.zeros(len(length), np.int64)
    short = order[:np.searchsorted(length[order], MATRIX_LIMIT, "right")]
    flat, owners = [], []
    a = 0
    while a < len(short):
        width = int(length[short[a]])
        width += width // 4 if width > 8 else 0                 # similar lengths share a matrix
        z = min(a + 8192, int(np.searchsorted(length[short], width, "right")))
        rows = short[a:z]
        mat = np.full((len(rows), width), PAD, np.int32)
        mat[np.arange(width) < length[rows][:, None]] = symbols[ranges(first[rows], length[rows])]
        got = merge_matrix(v, mat, key[rows], rate)
        real = got != PAD
        sizes[rows] = real.sum(1)
        flat.append(got[real].astype(np.int64))
        owners.append(rows)
        a = z
    for r in order[len(short):]:
        got = merge_heap(v, symbols[first[r]:first[r] + length[r]].tolist(), int(key[r]), rate)
        sizes[r] = len(got)
        flat.append(np.array(got, np.int64))
        owners.append(np.array([r]))
    if not flat:
        return np.zeros(0, np.int64), sizes
    flat, owners = np.concatenate(flat), np.concatenate(owners)
    at = np.zeros(len(length), np.int64)
    at[owners] = np.cumsum(sizes[owners]) - sizes[owners]
    return flat[ranges(at, sizes)], sizes


def spell(v: Pieces, symbols: np.ndarray, length: np.ndarray):
    """Replace symbols that are not pieces by the pieces of their UTF-8 bytes."""
    odd = np.flatnonzero(symbols >= v.size)
    if not len(odd):
        return symbols, length
    codes, inverse = np.unique(symbols[odd], return_inverse=True)
    raw = [(v.char_of.get(int(c)) or chr(int(c) - v.base)).encode("utf-8", "surrogatepass") for c in codes]
    pool = np.concatenate([symbols, v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]])
    size = np.array([len(r) for r in raw])
    start, count = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
    start[odd] = (len(symbols) + np.cumsum(size) - size)[inverse]
    count[odd] = size[inverse]
    total = np.concatenate([[0], np.cumsum(count)])
    ends = np.cumsum(length)
    return pool[ranges(start, count)], total[ends] - total[ends - length]


class Encoder:
    def __init__(self, path: str | None = None, rate: float = 0.1, seed: int = 1):
        self.v, self.rate = vocabulary(path or model_path()), rate
        self.seed = U64(int.from_bytes(hashlib.sha256(f"dropout:{seed}".encode()).digest()[:8], "little"))

    def encode(self, raw: np.ndarray, offsets: np.ndarray, doc_keys: np.ndarray):
        """UTF-8 rows -> (flat ids, ids of each row). doc_keys: 64 bits per row."""
        size = np.diff(offsets)
        full = np.flatnonzero(size)
        if not len(full):
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        start = offsets[:-1][full] - offsets[0] + np.arange(len(full))        # each row gets a blank in front
        b = np.full(int(offsets[-1] - offsets[0]) + len(full), 32, np.uint8)
        keep = np.ones(len(b), bool)
        keep[start] = False
        b[keep] = raw[offsets[0]:offsets[-1]]
        blank = b == 32
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        if self.v.breaks:                                                   # line feeds stand alone
            line = b == 10
            cut |= line
            cut[1:] |= line[:-1]
        cut[start] = True
        at = np.flatnonzero(cut)
        end = np.append(at[1:], len(b))
        if self.rate > 0:
            row = np.searchsorted(start, at, "right") - 1
            place = (np.arange(len(at)) - np.searchsorted(at, start)[row]).astype(U64)
            key = mix64(mix64(doc_keys[full] + self.seed)[row] + place * _K1)
            where = which = np.arange(len(at))
        else:
            key, where, which = np.unique(span_hashes(b, at, end), return_index=True, return_inverse=True)
        lens = end[where] - at[where]
        data = b[ranges(at[where], lens)]
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), np.cumsum(lens) - lens)
        ids, n = merge_units(self.v, self.v.symbol_of[points], chars, key, self.rate)
        ids, n = spell(self.v, ids, n)
        first = np.cumsum(n) - n
        per_unit = n[which]
        out = np.zeros(len(size), np.int64)
        out[full] = np.add.reduceat(per_unit, np.searchsorted(at, start))
        return ids[ranges(first[which], per_unit)], out


class Decoder:
    def __init__(self, path: str | None = None):
        v = vocabulary(path or model_path())
        self.pool = np.frombuffer(b"".join(v.raw), np.uint8)
        self.len = np.array([len(r) for r in v.raw])
        self.first = np.cumsum(self.len) - self.len

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        n = self.len[ids]
        data = self.pool[ranges(self.first[ids], n)].tobytes()
        total = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(counts)
        return [data[a + 1:z] for a, z in zip(total[ends - counts].tolist(), total[ends].tolist())]


def encoded_batches(batches, path: str, rate: float, seed: int):
    """(key, text, 64 bits) batches -> (key, text_sha256, ids), a batch for each slice of about ``SLICE`` bytes of text."""
    e = _cached(("e", path, rate, seed), lambda: Encoder(path, rate, seed))
    for batch in batches:
        raw, off = text_buffer(batch.column(1))
        keys = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
        for a, z in slices(off, SLICE):
            ids, n = e.encode(raw, off[a:z + 1], keys[a:z])
            sha = [hashlib.sha256(raw[s:t]).hexdigest() for s, t in zip(off[a:z].tolist(), off[a + 1:z + 1].tolist())]
            ends = np.concatenate([[0], np.cumsum(n)])
            if ends[-1] >= 2**31:
                raise ValueError("one slice of texts has over 2**31 pieces")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), pa.array(sha, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())).cast(pa.list_(pa.int32()))],
                names=["key", "text_sha256", "ids"])
        release()


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, rate: float = 0.1,
                 seed: int = 1, then=None, schema: str = "key {kind}, text_sha256 string, ids array<int>") -> DataFrame:
    """(key, text_sha256 of the input, ids) for each row. Null text: no ids.

    Rows with the same key and text are copies, numbered from 0; each has its own
    segmentation, and which row is which copy makes no difference. Columns
    besides key and text are not read. Empty table: no rows. ``then`` maps the
    record batches of the result to those of ``schema`` ({kind}: the key's type)
    in the worker that made them, where a second map would start another worker.
    """
    path = path or model_path()
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        made = encoded_batches(batches, path, rate, seed)
        return then(made) if then else made

    slim, copy = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), F.lit(0)
    if rate > 0 and not slim.groupBy("key").count().filter("count > 1").isEmpty():
        copy = F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1))
        slim = slim.groupBy("key", "text").count()             # copies are counted before they shuffle
    slim = slim.select("key", "text", copy.alias("copy"))
    slim = slim.select("key", "text", F.xxhash64(F.col("key").cast("string"), "text", "copy").alias("h"))
    return slim.mapInArrow(releasing(run), schema.replace("{kind}", kind))


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(key, text_sha256, ids) -> the same plus ``text``, from the ids alone."""
    path = path or model_path()

    def run(batches):
        d = _cached(("d", path), lambda: Decoder(path))
        for batch in batches:
            ids = batch.column("ids")
            for a in range(0, batch.num_rows, 256):                          # texts are about twice the ids' bytes
                part = ids.slice(a, 256)
                texts = d.decode(part.flatten().to_numpy(), np.diff(part.offsets.to_numpy()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 256), batch.column(1).slice(a, 256), part,
                                                  pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                                                 names=["key", "text_sha256", "ids", "text"])

    kind = encoded.schema["key"].dataType.simpleString()
    return encoded.mapInArrow(run, f"key {kind}, text_sha256 string, ids array<int>, text string")


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, **kw) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (ids as little-endian 32-bit), text_sha256 of
    the decoded text, lossless (equal to the digest of the input), per row."""
    path = path or model_path()

    def run(batches):
        d = _cached(("d", path), lambda: Decoder(path))
        for batch in batches:
            ids = batch.column("ids")
            crc, sha = [], []
            for a in range(0, batch.num_rows, 256):
                part = ids.slice(a, 256)
                flat, off = part.flatten().to_numpy().astype("<i4"), part.offsets.to_numpy()
                off = off - off[0]
                sha += [hashlib.sha256(t).hexdigest() for t in d.decode(flat, np.diff(off))]
                crc += [zlib.crc32(flat[s:t]) for s, t in zip(off[:-1].tolist(), off[1:].tolist())]
            n = pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64))
            same = pa.array([x == y for x, y in zip(sha, batch.column(1).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(crc, pa.int64()), pa.array(sha, pa.string()), same],
                                             names=["doc_id", "n_pieces", "ids_crc32", "text_sha256", "lossless"])

    return encode_texts(df, key, text, path, then=run,
                        schema="doc_id {kind}, n_pieces long, ids_crc32 long, text_sha256 string, lossless boolean", **kw)


def vocabulary(path: str) -> Pieces:
    return _cached(("v", path), lambda: Pieces(path))


_made: dict = {}


def _cached(key, make):
    """One table per worker process."""
    if key not in _made:
        _made[key] = make()
    return _made[key]


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
