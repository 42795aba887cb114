"""Token ids in range-coded binary files, written in ascending id order.

Texts are dealt by ranges of doc_id, so file k holds smaller ids than file k+1,
and each task writes one file: a header, range-coded blocks (``rangecoder``,
each reset and checksummed), and a footer with the documents' ids and lengths,
also checksummed. Only a group of blocks is in memory at a time. Files are
found by the manifest; a task that runs again writes a new file.

The tokenizer's rules never look across ASCII blanks, so the ids of a text are
those of its words in turn, and each distinct word is looked at once. Of words
of plain characters it sees only the distinct pre-tokens: "Word", "word," and
"(word)" share one. Words and pre-tokens are the same when two independent 64-bit
hashes agree; one that shares only the first with another is encoded by itself.
Texts are encoded whole, a very long one as a slice of its own.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.sinks import scratch_dir
from . import arrays
from . import rangecoder as rc
from .arrays import LOWER, U64, Words, ranges, release, slices, text_buffer
from .shared_files import one_task_per_file, open_file, write_file

MAGIC = b"TOKRC002"
FOOTER = struct.Struct("<QIQ8s")          # documents, crc of the footer's body, its bytes, magic
NULL_ID = -1 << 63                        # null ids sort first and are marked by a flag byte


def model_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Characters whose pre-token the tokenizer's pattern decides alone: ASCII letters, digits and
# signs, and the letters of Latin-1 and Latin Extended-A (lead bytes C3 to C5). An apostrophe may
# start a contraction and "<" a special token; words with those or any other byte go alone.
_LETTER, _DIGIT, _SIGN, _ALONE = 0, 1, 2, 3
_KIND = np.full(256, _ALONE, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[ord("'"), ord("<")]] = _ALONE
# Not letters, or not one letter in lower case: multiplication and division sign, dotted I, n with apostrophe.
_ODD_PAIRS = (0xC397, 0xC3B7, 0xC4B0, 0xC589)
TOGETHER = 64                             # pre-tokens encoded in one call


def pre_tokens(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a buffer of words: the number of pre-tokens of each word, 0 where it must
    go alone, and whether a pre-token starts at a byte."""
    kind = _KIND[data]
    pair = (data[:-1].astype(np.int32) << 8) | data[1:]
    alone = kind == _ALONE
    alone[:-1] |= np.isin(pair, _ODD_PAIRS)
    new = kind == _DIGIT
    new[1:] |= kind[1:] != kind[:-1]
    new[start] = True
    return np.where(np.add.reduceat(alone, start, dtype=np.int64) > 0, 0, np.add.reduceat(new, start, dtype=np.int64)), new


def plain_form(path: str, tok):
    """The tokenizer without its normaliser and pattern, for ASCII words in lower case
    that are cut into pre-tokens already: there both change nothing. None where the
    file's rules are others than NFC, blanks, lower case, one pattern and byte symbols."""
    rules = json.loads(tok.to_str())
    norm = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
    pre = [x["type"] for x in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if norm != ["NFC", "Replace", "Lowercase"] or pre != ["Split", "ByteLevel"]:
        return None
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    plain = Tokenizer.from_file(path)
    plain.normalizer, plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
    return plain


class Kept:
    """Ids of spans of bytes, each distinct span given to ``learn`` once: spans -> (ids, place and number of each span's)."""

    def __init__(self, learn, keep: int):
        self.learn, self.keep = learn, keep
        self._clear()

    def _clear(self):
        self.key, self.check = np.zeros(0, U64), np.zeros(0, U64)       # both hashes, by the first
        self.at, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def _store(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Append the spans' ids to the pool; returns where they are and how many."""
        ids, place, size = self.learn(raw, start, end)
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool[:at], np.zeros(max(at, self.used - at), np.int32)])
        self.pool[at:self.used] = ids
        return place + at, size

    def ids(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids of each span)."""
        check = arrays.span_hashes(raw, start, end, 1)
        which, keys = pd.factorize(arrays.span_hashes(raw, start, end))
        where = np.empty(len(keys), np.int64)
        where[which[::-1]] = np.arange(len(which) - 1, -1, -1)          # the first of each
        if len(self.key) + len(keys) > self.keep:
            self._clear()
        order = np.argsort(keys)
        keys, where = keys[order], where[order]
        slot = np.searchsorted(self.key, keys)
        known = np.zeros(len(keys), bool)
        if len(self.key):
            known = self.key.take(slot, mode="clip") == keys
        new = np.flatnonzero(~known)
        if len(new):
            rows = where[new]
            at, size = self._store(raw, start[rows], end[rows])
            for name, x in (("key", keys[new]), ("check", check[rows]), ("at", at), ("len", size)):
                setattr(self, name, np.insert(getattr(self, name), slot[new], x))
            slot += np.cumsum(~known) - ~known                          # those put in before it
        back = np.empty_like(order)
        back[order] = slot
        at, size = self.at[back].take(which), self.len[back].take(which)
        other = np.flatnonzero(self.check[back].take(which) != check)   # another span of the same first hash
        if len(other):
            at[other], size[other] = self._store(raw, start[other], end[other])
        return self.pool[ranges(at, size)], size


class PatternDiffers(Exception):
    """The library cuts a text into other pre-tokens than ``pre_tokens``."""


class WordTokenizer:
    """Ids of texts by way of their distinct words, and of these by way of their
    distinct pre-tokens; both are kept for later batches."""

    def __init__(self, path: str, keep: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.plain = plain_form(path, self.tok) or self.tok
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.vocab = max(vocab.values()) + 1
        self.ends = np.zeros(self.vocab, bool)                # ids that end a pre-token
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words, self.pieces = Kept(self._encode_words, keep), Kept(self._encode_pieces, keep)

    def _encode_alone(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), np.int32), np.array([len(x) for x in got], np.int64)

    def _encode_together(self, tok, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Many pre-tokens to a call, told apart again by the ids that end one."""
        groups = [pieces[i:i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        got = [np.array(e.ids, np.int32) for e in tok.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)]
        if any(np.count_nonzero(self.ends[x]) != len(g) or not self.ends[x[-1]] for x, g in zip(got, groups)):
            raise PatternDiffers
        flat = np.concatenate(got)
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)

    def _encode_pieces(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Encode pre-tokens, A-Z lowered."""
        source = raw.tobytes()
        lens = end - start
        wide = np.add.reduceat(raw[ranges(start, lens)] > 127, np.cumsum(lens) - lens, dtype=np.int64) > 0
        ids, place, size, used = [], np.empty(len(start), np.int64), np.empty(len(start), np.int64), 0
        for rows, tok in ((np.flatnonzero(~wide), self.plain), (np.flatnonzero(wide), self.tok)):
            if len(rows):
                flat, n = self._encode_together(tok, [source[i:j] for i, j in zip(start[rows].tolist(), end[rows].tolist())])
                place[rows], size[rows] = used + np.cumsum(n) - n, n
                ids.append(flat)
                used += len(flat)
        return np.concatenate(ids), place, size

    def _encode_words(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Encode words: by their pre-tokens where these are plain to see."""
        lens = end - start
        data = raw[ranges(start, lens)]
        first = np.cumsum(lens) - lens
        counts, new = pre_tokens(data, first)
        ids, place, size = np.zeros(0, np.int32), np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        cut = counts > 0
        if cut.any():
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(data))
            inside = np.repeat(cut, lens)[a]
            try:
                ids, n = self.pieces.ids(LOWER[data], a[inside], z[inside])
                size[cut] = np.add.reduceat(n, np.cumsum(counts[cut]) - counts[cut])
                place[cut] = np.cumsum(size[cut]) - size[cut]
            except PatternDiffers:
                cut[:] = False
        alone = np.flatnonzero(~cut)
        if len(alone):
            source = data.tobytes()
            flat, n = self._encode_alone([source[i:i + k] for i, k in zip(first[alone].tolist(), lens[alone].tolist())])
            place[alone], size[alone] = len(ids) + np.cumsum(n) - n, n
            ids = np.concatenate([ids, flat])
        return ids, place, size

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids of each row)."""
        w = Words(raw, offsets)
        if not len(w.start):
            return np.zeros(0, np.int32), np.zeros(len(w.counts), np.int64)
        ids, size = self.words.ids(raw, w.start, w.end)
        total = np.concatenate([[0], np.cumsum(size)])
        return ids, total[w.row_end] - total[w.row_start]


_made: dict = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]


def append_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """One end id after each row."""
    out = np.full(len(ids) + len(counts), end, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts) + np.arange(len(counts))] = False
    out[keep] = ids
    return out, counts + 1


def file_chunks(batches, tok: WordTokenizer, end: int, tally: dict):
    """The bytes of one file, from (doc_id, text) batches in file order."""
    vocab = max(tok.vocab, end + 1)
    yield MAGIC + struct.pack("<I", vocab)
    full = rc.LANES * rc.STEPS * rc.GROUP
    held, n_held, docs, nulls, lengths = [], 0, [], [], []
    for batch in batches:
        raw, off = text_buffer(batch.column(1))
        docs.append(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        nulls.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
        for a, z in slices(off, 1 << 22):
            ids, counts = append_end(*tok.encode(raw[off[a]:off[z]], off[a:z + 1] - off[a]), end)
            lengths.append(counts)
            held.append(ids)
            n_held += len(ids)
            if n_held >= full:
                ids = np.concatenate(held)
                cut = n_held // full * full
                yield from rc.encode_blocks(ids[:cut], vocab)
                held, n_held = [ids[cut:]], n_held - cut
    if n_held:
        yield from rc.encode_blocks(np.concatenate(held), vocab)
    ids, null, length = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((docs, np.int64), (nulls, bool), (lengths, np.int64)))
    body = zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes() + np.packbits(null).tobytes() + length.astype("<i8").tobytes(), 1)
    tally |= {"docs": len(ids), "tokens": int(length.sum())}
    yield rc.HEAD.pack(0, 0, 0, len(body), 0, 0) + body
    yield FOOTER.pack(len(ids), zlib.crc32(body), len(body), MAGIC)


def read_file(uri: str):
    """The documents of a file, in order: yields (doc ids, null flags, lengths)
    once, then arrays of ids that continue each other."""
    with open_file(uri) as f:
        size = f.size()
        n, crc, body_size, magic = FOOTER.unpack(f.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        body = f.read_at(body_size, size - FOOTER.size - body_size)
        if zlib.crc32(body) != crc:
            raise ValueError(f"{uri}: the footer does not match its checksum")
        data = zlib.decompress(body)
        flag = 8 * n + (n + 7) // 8
        ids = np.cumsum(np.frombuffer(data, "<i8", n))
        yield ids, np.unpackbits(np.frombuffer(data[8 * n:flag], np.uint8), count=n).astype(bool), np.frombuffer(data, "<i8", n, flag)
        f.seek(0)
        head = f.read(len(MAGIC) + 4)
        vocab = struct.unpack("<I", head[len(MAGIC):])[0]
        if not head.startswith(MAGIC):
            raise ValueError(f"{uri}: not a token file")
        group = []
        while True:
            fields = rc.HEAD.unpack(f.read(rc.HEAD.size))
            if fields[0]:
                group.append((fields, f.read(fields[3])))
            if group and (not fields[0] or len(group) == rc.GROUP):
                yield from rc.decode_blocks(group, vocab)
                group = []
            if not fields[0]:
                return


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end: int = 1, id_col: str = "doc_id",
                 text: str = "text", file_bytes: int = 12 << 20) -> DataFrame:
    """Write all rows in ascending id order; returns (part, uri, docs, tokens)."""
    path = path or model_path()
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = slim.repartitionByRange(max(1, int(total // file_bytes)), "doc_id") \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return

        def every():
            yield first
            yield from batches

        tally: dict = {}
        uri = write_file(folder, ".tok", file_chunks(every(), tokenizer(path), end, tally))
        release()
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "uri": [uri],
                                          "docs": pa.array([tally["docs"]], pa.int64()), "tokens": pa.array([tally["tokens"]], pa.int64())})

    return materialize(dealt.mapInArrow(write, "part long, uri string, docs long, tokens long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """The files' documents: part, doc_id, at (first id in the file), ids as binary (little-endian 32-bit)."""

    def read(batches):
        for batch in batches:
            for part, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                content = read_file(uri)
                ids, null, length = next(content)
                end = np.cumsum(length)
                start, done, held, base = end - length, 0, np.zeros(0, np.uint32), 0
                for piece in content:
                    held = np.concatenate([held, piece])
                    ready = int(np.searchsorted(end, base + len(held), "right"))
                    if ready > done:
                        a = held.astype("<u4").tobytes()
                        rows = range(done, ready)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part] * len(rows), pa.int64()), pa.array(ids[done:ready], pa.int64(), mask=null[done:ready]),
                             pa.array(start[done:ready]), pa.array([a[4 * (start[i] - base):4 * (end[i] - base)] for i in rows], pa.binary())],
                            names=["part", "doc_id", "at", "ids"])
                        held, base, done = held[end[ready - 1] - base:], int(end[ready - 1]), ready
                if done != len(ids) or len(held):
                    raise ValueError(f"{uri}: blocks and footer disagree")
                release()

    return one_task_per_file(manifest.select("part", "uri"), "uri").mapInArrow(read, "part long, doc_id long, at long, ids binary")


def token_files(docs: DataFrame, path: str | None = None, end: int = 1, **kw) -> DataFrame:
    """Write, read back: doc_id, start, n_tokens, ids_crc32 of every row.

    Null text: empty, so one id (the end). Null ids come first. Rows of equal id
    are separate documents, in a fixed order. Empty table: no rows. Columns
    besides id and text are not read.
    """
    folder = scratch_dir(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, path, end, **kw)
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.select(F.col("part").alias("_part"), before.alias("base"))          # one row per file
    rows = read_tokens(manifest).select("part", "doc_id", "at", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                        F.crc32("ids").alias("ids_crc32"))
    return materialize(rows).join(starts, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_output(spark, sf_dir: str) -> DataFrame:
    return token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"))
