"""SimHash near-dedup with multi-index hashing.

A fingerprint has bit j set if more than half of a text's shingle hashes have it.
Equal fingerprints are one entry. Two fingerprints within ``radius`` bits agree,
in one of two 32-bit segments, nearly enough for a small Hamming ball: for two
bits, the low segments differ in at most one bit or the high segments are
equal. Every fingerprint stands in a table under the value of each segment and
looks up the ball around its own: 33 values of the low, one of the high segment.
Matches of a table entry are verified on all 64 bits.

Lookups that hit nothing are dropped by a count per table entry. An entry with
more than ``max_run`` rows (a group of copies whose segment is equal) is looked up
by a second index instead, of the same kind over the two 16-bit halves of the
other segment: its entries hold at most 2**16 fingerprints, whatever the input.

Only components are wanted, so a task reports the links that join something new:
at most one for each fingerprint it holds, never the pairs of a group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import LOWER, ranges, release
from .components import components

SEGMENT, HALF = 32, 16
SEED = 42
LOWER_TABLE = LOWER.tobytes()
PIECE = 1 << 20
LINK = "a long, b long"


# -- fingerprints --------------------------------------------------------------

def pieces(text: bytes, size: int = PIECE):
    """The words of a text in lists of about ``size`` bytes of it."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end].split()                             # bytes.split() takes [\x20\x09-\x0D]
        at = end


def fingerprint(text: str | None, width: int = 3, piece: int = PIECE) -> int:
    """The 64-bit SimHash of a text; 0 without words. A long text is taken in pieces."""
    ones, n, before = np.zeros(64, np.int64), 0, []
    for words in pieces((text or "").encode().translate(LOWER_TABLE), piece):
        words = before + words
        if len(words) >= width:
            line = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size + 1) - 1
            spans = zip((end - size)[:len(words) - width + 1].tolist(), end[width - 1:].tolist())
            h = np.fromiter((xxhash.xxh64_intdigest(line[a:z], SEED) for a, z in spans), np.uint64, len(words) - width + 1)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(h)
        before = words[len(words) - width + 1:] if len(words) >= width else words
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(before), SEED) if before else 0
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(x.as_py(), width) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])
            release()

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


# -- the tables ------------------------------------------------------------------

def balls(radius: int) -> tuple[int, int]:
    """Ball radius in each of two segments that together find every pair within
    ``radius``; -1: the segment need not be searched."""
    r, rest = divmod(radius, 2)
    return (r, r) if rest else (r, r - 1)


def masks(bits: int, radius: int) -> list[tuple[int, int]]:
    """(mask, bits set) of a Hamming ball around zero."""
    return [(sum(1 << b for b in c), k) for k in range(radius + 1) for c in combinations(range(bits), k)]


def _lookups(options: list[tuple[int, int, int]], name: str):
    """explode of (segment, mask, bits set)."""
    rows = [F.struct(F.lit(s).alias("seg"), F.lit(x).cast("long").alias("mask"), F.lit(k).alias("delta")) for s, x, k in options]
    return F.explode(F.array(*rows)).alias(name)


def _part(fp, seg, bits: int):
    """Segment ``seg`` of a value cut into segments of ``bits``."""
    return F.call_function("shiftrightunsigned", fp, (seg * bits).cast("int")).bitwiseAND(F.lit((1 << bits) - 1))


def first_index(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, key, delta): under its own segment values (delta 0) and within the balls."""
    options = [(s, x, k) for s, r in enumerate(balls(radius)) for x, k in masks(SEGMENT, max(r, 0))]
    at = fps.select("fp", _lookups(options, "o"))
    return at.select("fp", (F.shiftleft(F.col("o.seg").cast("long"), SEGMENT) + _part(F.col("fp"), F.col("o.seg"), SEGMENT)
                            .bitwiseXOR(F.col("o.mask"))).alias("key"), F.col("o.delta").alias("delta"), (F.col("o.delta") == 0).alias("home"))


def second_index(rows: DataFrame, radius: int) -> DataFrame:
    """The rows of full entries under (key, half of the other segment)."""
    out = None
    for delta in range(radius // 2 + 1):
        options = [(s, x, k) for s, r in enumerate(balls(radius - delta)) if r >= 0 or not delta for x, k in masks(HALF, max(r, 0))]
        at = rows.filter(F.col("delta") == delta).select("fp", "key", _lookups(options, "o"))
        other = _part(F.col("fp"), 1 - F.shiftright("key", SEGMENT), SEGMENT)
        value = _part(other, F.col("o.seg"), HALF).bitwiseXOR(F.col("o.mask"))
        key = F.shiftleft("key", HALF + 1) + F.shiftleft(F.col("o.seg").cast("long"), HALF) + value
        at = at.select("fp", key.alias("key"), F.lit(delta).alias("delta"), ((F.col("o.delta") == 0) & F.lit(delta == 0)).alias("home"))
        out = at if out is None else out.unionByName(at)
    return out


def live(rows: DataFrame) -> DataFrame:
    """The rows under keys where a fingerprint stands and another row looks, with
    their number ``n``; written."""
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("any")).filter("any AND n > 1").select("key", "n")
    return materialize(rows.join(keys, "key"))


# -- links -----------------------------------------------------------------------

class Union:
    """Disjoint sets over 0..n-1; keeps the links that joined two of them."""

    def __init__(self, n: int):
        self.up, self.found = np.arange(n), []

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]
        ra, rb = self.up[a], self.up[b]
        new = np.flatnonzero(ra != rb)
        _, first = np.unique(np.minimum(ra[new], rb[new]) * len(self.up) + np.maximum(ra[new], rb[new]), return_index=True)
        for k in new[first].tolist():
            x, y = self.find(ra[k]), self.find(rb[k])
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.found.append((a[k], b[k]))


def verified(radius: int, most: int = 1 << 20):
    def run(table: pa.Table) -> pa.Table:
        """Links, found under the keys of a bucket, that join fingerprints."""
        key, fp = table["key"].to_numpy(), table["fp"].to_numpy()
        home = table["home"].to_numpy(zero_copy_only=False)
        order = np.lexsort((~home, key))
        key, fp, home = key[order], fp[order], home[order]
        start = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        first = np.repeat(start, np.diff(start, append=len(key)))
        homes = np.repeat(np.add.reduceat(home, start, dtype=np.int64), np.diff(start, append=len(key)))
        meets = np.minimum(np.arange(len(key)) - first, homes)  # the fingerprints that stand there, before the row
        names, which = np.unique(fp, return_inverse=True)
        joined = Union(len(names))
        total = np.concatenate([[0], np.cumsum(meets)])
        a = 0
        while a < len(key):
            z = max(a + 1, int(np.searchsorted(total, total[a] + most, "right")) - 1)
            left, right = np.repeat(np.arange(a, z), meets[a:z]), ranges(first[a:z], meets[a:z])
            near = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= radius
            joined.add(which[left[near]], which[right[near]])
            a = z
        pairs = np.array(joined.found, np.int64).reshape(-1, 2)
        release()
        return pa.table({"a": pa.array(names[pairs[:, 0]]), "b": pa.array(names[pairs[:, 1]])})

    return run


def _in_buckets(rows: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    n = max(1, -(-rows.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64("key"), F.lit(n)).alias("bucket")
    return rows.groupBy(bucket).applyInArrow(verified(radius), LINK)


def linked(fps: DataFrame, radius: int = 2, max_run: int = 4096, bucket_rows: int = 200_000) -> DataFrame:
    """(fp, root) of a table of distinct ``fp``: the least of those reachable by links,
    for every fingerprint that has a link and is not itself the least."""
    rows = live(first_index(fps, radius))
    few = rows.filter(F.col("n") <= max_run)
    full = rows.filter(F.col("n") > max_run).select("fp", "key", "delta")
    edges = _in_buckets(few, radius, bucket_rows)
    if not full.isEmpty():
        edges = edges.unionByName(_in_buckets(live(second_index(full, radius)), radius, bucket_rows))
    return components(edges).select(F.col("node").alias("fp"), "root")


def simhash_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = 3, radius: int = 2,
                       max_run: int = 4096, bucket_rows: int = 200_000) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id of the component) for each row.

    Null or empty text, or one of blanks: fingerprint zero, linked like any other.
    Fewer words than ``width``: the whole sequence is one shingle. Very long texts are
    read whole, in pieces. Null ids count as larger than all others: a component's id
    is null only if all its ids are. Repeated rows and equal texts share a fingerprint
    and so a component; ids need not be unique. Empty table: no rows. Only the text and
    id columns are read, whatever the others are named.
    """
    rows = materialize(fingerprints(docs, text, id_col, width))
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = fps.join(materialize(linked(fps.select("fp"), radius, max_run, bucket_rows)), "fp", "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of = materialize(roots.join(least, "root").select(F.col("fp").alias("_fp"), "component_id"))
    return rows.join(of, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
