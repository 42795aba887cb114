"""Jaccard self-join on word shingles with signature trees, as link components.

A document's set holds its distinct five-word shingles (A-Z lowered; a shorter
text is one shingle). Two documents link at Jaccard >= 0.8, exactly. The result
names the components of the links, so links that join nothing new need not be
found, and no group is ever expanded into pairs.

1. Documents with the same set are one class.
2. Candidates. In hash order, two linking sets share at least k of their first
   ``n - ceil(0.8 n) + k`` shingles (k = n / 5, of the smaller set). Chunks ask
   buckets how many classes hold each of these shingles, and sort them rarest
   first. Leaving out the last k - 1 there still leaves one that both sets have:
   the prefix. A class whose prefix is all its own links with nothing; most
   texts, also those that share a passage, end here.
3. Signature trees. Candidates meet where their most shared prefix shingle
   is the same. A tree over the group has nodes with OR-combined token bitmaps
   (with the largest multiplicity per bit) and size ranges; a traversal of node
   pairs prunes by size and by the maximum possible overlap, skips node pairs
   that are one component already, and checks the rest exactly.
   Groups over ``max_group`` are split by hash.
4. A shingle is open while classes of different components have it in their
   prefix. Where groups were split, one pair per pair of components is checked
   for two rounds, which joins most parts again. Then the members of every
   shingle still open meet in the tree of the shingle's leader, its member of
   least hash: the shingles of one cluster have few leaders, so a set travels a
   few times, not once per shingle. Groups over ``max_group`` meet in blocks. No
   open shingle is left out, so no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrays import LOWER, U64, Words, mix64, ranges, release, releasing, slices, text_buffer, window_hashes
from .components import components
from .exchange import ASK, ask_table, low_bucket, pack_sorted, plan, split_buckets, unpack_sorted

BITS = 512
LEAF = 8


# -- sets --------------------------------------------------------------------

def need(n):
    """Least overlap of a set of n with any set it links with."""
    return -(-4 * n // 5)


def depth(n):
    """k: shared shingles that are asked for in the first need() + k."""
    return np.maximum(1, n // 5)


class Sets:
    """Shingle sets of a table's rows, each sorted by hash."""

    def __init__(self, text, width: int):
        raw, off = text_buffer(text)
        w = Words(LOWER[raw], off)
        h, counts = w.hashes(), w.counts
        n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        at = ranges(w.row_start, n)
        row = np.repeat(np.arange(len(counts)), n)
        values = np.zeros(len(at), U64)
        full = counts[row] >= width
        if full.any():
            values[full] = window_hashes(h, width)[at[full]]
        for k in range(1, width):                              # the whole text as one shingle
            short = counts[row] == k
            if short.any():
                values[short] = mix64(window_hashes(h, k)[at[short]] + U64(k))
        order = np.lexsort((values, row))
        values, row = values[order], row[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
        self.values, self.row = values[new], row[new]
        self.n = np.bincount(self.row, minlength=len(counts))
        self.first = np.cumsum(self.n) - self.n
        a, b = mix64(self.values), mix64(self.values ^ U64(0x5851F42D4C957F2D))
        total = np.zeros((len(counts), 2), U64)
        some = self.n > 0
        if some.any():
            total[some, 0] = np.add.reduceat(a, self.first[some])
            total[some, 1] = np.add.reduceat(b, self.first[some])
        self.key = [x.tobytes() for x in total]                # 128 bits: the class


def class_rows(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, t, n, cls) of every row; t is a hash of the text."""

    def run(batches):
        for batch in batches:
            text = batch.column(1)
            _, off = text_buffer(text)
            for a, z in slices(off, 1 << 19):
                s = Sets(text.slice(a, z - a), width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), batch.column(2).slice(a, z - a),
                                                  pa.array(s.n.astype(np.int64)), pa.array(s.key, pa.binary())],
                                                 names=["doc_id", "t", "n", "cls"])
            release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("t")).mapInArrow(
        releasing(run), "doc_id long, t long, n long, cls binary")


class Chunk:
    """Sets of the chunk's class representatives and their asked shingles."""

    def __init__(self, table: pa.Table, reps: set, width: int, n_buckets: int):
        self.sets, self.n_buckets = Sets(table["text"], width), n_buckets
        s = self.sets
        left = set(reps)
        own = np.zeros(len(s.n), bool)
        for i, key in enumerate(s.key):
            if key in left:
                left.discard(key)
                own[i] = s.n[i] > 0
        self.rows = np.flatnonzero(own)
        n = s.n[self.rows]
        self.asked = n - need(n) + depth(n)
        self.at = ranges(s.first[self.rows], self.asked)
        h = s.values[self.at]
        key = (low_bucket(h, n_buckets) << U64(32)) | (h >> U64(32))
        self.uniq, self.inverse = np.unique(key, return_inverse=True)

    def ask(self, chunk: int) -> pa.Table:
        count = np.minimum(np.bincount(self.inverse, minlength=len(self.uniq)), 255).astype(np.uint8)
        rest = (self.uniq & U64(0xFFFFFFFF)).astype(np.uint32)
        return ask_table(chunk, [(b, z - a, pack_sorted(rest[a:z]) + count[a:z].tobytes())
                                 for b, a, z in split_buckets(self.uniq >> U64(32), self.n_buckets)])

    def candidates(self, got: dict[int, bytes]) -> pa.Table:
        shared = np.zeros(len(self.uniq), np.uint8)
        for b, a, z in split_buckets(self.uniq >> U64(32), self.n_buckets):
            shared[a:z] = np.frombuffer(got[b], np.uint8)
        shared = shared[self.inverse]
        out, at = [], 0
        for row, asked in zip(self.rows.tolist(), self.asked.tolist()):
            s, n = shared[at:at + asked], int(self.sets.n[row])
            at += asked
            rare = np.argsort(s, kind="stable")[:asked - depth(need(n)) + 1]    # rarest first, then least hash
            rare = rare[s[rare] > 0]
            if not len(rare):
                continue
            own = self.sets.values[self.sets.first[row]:self.sets.first[row] + n]
            prefix = own[rare]
            home = prefix[np.argmax(s[rare])]                   # the most shared of them, then least hash
            out.append((self.sets.key[row], n, int(home.view(np.int64)), prefix.view(np.int64).tolist(), own.tobytes()))
        schema = pa.schema([("cls", pa.binary()), ("n", pa.int64()), ("home", pa.int64()), ("prefix", pa.list_(pa.int64())),
                            ("items", pa.binary())])
        return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)


def judge(asked: pa.Table) -> pa.Table:
    """A byte per record: 0 if one class alone has the shingle, else rising with their number."""
    parts, count = [], []
    for n, data in zip(asked["n"].to_pylist(), asked["payload"].to_pylist()):
        parts.append(unpack_sorted(data, n, np.uint32))
        count.append(np.frombuffer(data, np.uint8, offset=4 * n))
    both = (np.concatenate(parts).astype(U64) << U64(32)) | np.arange(sum(map(len, parts)), dtype=U64)
    both.sort()
    order, value, count = (both & U64(0xFFFFFFFF)).astype(np.int64), both >> U64(32), np.concatenate(count).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    total = np.add.reduceat(count[order], first)
    level = np.where(total > 1, np.minimum(255, 1 + np.floor(np.log2(np.maximum(total, 1)) * 6)), 0).astype(np.uint8)
    out = np.zeros(len(value), np.uint8)
    out[order] = np.repeat(level, np.diff(np.append(first, len(value))))
    cut = np.cumsum(asked["n"].to_numpy())[:-1]
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"],
                     "bits": pa.array([x.tobytes() for x in np.split(out, cut)], pa.binary())})


# -- signature tree ----------------------------------------------------------

def links(a: np.ndarray, b: np.ndarray) -> bool:
    i = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * i >= 80 * (len(a) + len(b) - i)


class Tree:
    """A binary tree over sets; node pairs are traversed together."""

    def __init__(self, sets: list[np.ndarray], labels: list | None = None, side: np.ndarray | None = None):
        order = sorted(range(len(sets)), key=lambda i: (sets[i][0], len(sets[i])))     # alike sets side by side
        self.ids, self.sets = order, [sets[i] for i in order]
        self.size = np.array([len(s) for s in self.sets])
        bits = np.stack([np.bincount((s >> U64(55)).astype(np.int64), minlength=BITS) for s in self.sets])
        self.bits = bits.astype(np.min_scalar_type(bits.max()))    # wide enough for every multiplicity: a cut one is no bound
        known: dict = {}
        self.comp = np.array([known.setdefault(labels[i], k) if labels is not None else k for k, i in enumerate(order)])
        self.side = None if side is None else side[order]     # only pairs of different sides, if given
        self.found: list[tuple[int, int]] = []
        self.nodes: list = []
        self._build(0, len(sets))

    def _build(self, a: int, z: int) -> int:
        kids = ()
        if z - a > LEAF:
            m = (a + z) // 2
            kids = self._build(a, m), self._build(m, z)
            bits = np.maximum(self.nodes[kids[0]][2], self.nodes[kids[1]][2])
        else:
            bits = self.bits[a:z].max(0)
        self.nodes.append((a, z, bits, int(self.size[a:z].min()), int(self.size[a:z].max()), kids))
        return len(self.nodes) - 1

    def join(self) -> list[tuple[int, int]]:
        """Links that join components, as pairs of positions in the input."""
        stack = [(len(self.nodes) - 1, len(self.nodes) - 1, False)]
        while stack:
            p, q, _ = stack.pop()
            a, b = self.nodes[p], self.nodes[q]
            if p != q:
                if 5 * a[4] < 4 * b[3] or 5 * b[4] < 4 * a[3]:
                    continue
                if 180 * int(np.minimum(a[2], b[2]).sum(dtype=np.int64)) < 80 * (a[3] + b[3]):
                    continue
            c, d = self.comp[a[0]:a[1]], self.comp[b[0]:b[1]]
            if (c == c[0]).all() and (d == c[0]).all():
                continue
            if p == q and a[5]:
                x, y = a[5]
                stack += [(x, y, True), (x, x, True), (y, y, True)]       # the halves first, then across
            elif a[5] or b[5]:
                if not b[5] or a[5] and a[1] - a[0] >= b[1] - b[0]:
                    stack += [(k, q, True) for k in a[5]]
                else:
                    stack += [(p, k, True) for k in b[5]]
            else:
                self._leaves(a, b, p == q)
        return self.found

    def _leaves(self, a, b, same: bool):
        ra, rb = np.arange(a[0], a[1]), np.arange(b[0], b[1])
        bound = np.minimum(self.bits[ra][:, None], self.bits[rb][None]).sum(-1, dtype=np.int64)
        may = 180 * bound >= 80 * (self.size[ra][:, None] + self.size[rb][None])
        if same:
            may &= ra[:, None] < rb[None]
        if self.side is not None:
            may &= self.side[ra][:, None] != self.side[rb][None]
        for i, j in np.argwhere(may):
            i, j = ra[i], rb[j]
            if self.comp[i] != self.comp[j] and links(self.sets[i], self.sets[j]):
                self.comp[self.comp == self.comp[j]] = self.comp[i]
                self.found.append((self.ids[i], self.ids[j]))


def tree_links(table: pa.Table) -> pa.Table:
    """(a, b) classes that link, from a group with cls, items and perhaps label, side."""
    cls = table["cls"].to_pylist()
    found = []
    if len(cls) > 1:
        sets = [np.frombuffer(x, U64) for x in table["items"].to_pylist()]
        labels = table["label"].to_pylist() if "label" in table.column_names else None
        side = None
        if "side" in table.column_names and len(set(table["side"].to_pylist())) > 1:
            side = table["side"].to_numpy()
        found = Tree(sets, labels, side).join()
    return pa.table({"a": pa.array([cls[i] for i, _ in found], pa.binary()), "b": pa.array([cls[j] for _, j in found], pa.binary())})


# -- the join ----------------------------------------------------------------

EDGE = "a binary, b binary"


def candidates(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """Classes that may link: cls, n, home, prefix, items. Texts are dealt to chunks once."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))     # one type, and so one hash, on both sides
    n_chunks, n_buckets = plan(docs)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("int").alias("chunk")
    by_chunk = docs.select(chunk, "doc_id", "text").groupBy("chunk")
    reps = classes.filter("n > 0").select(chunk, F.lit(-1).alias("bucket"), F.col("cls").alias("bits"))

    def open_(table, got):
        mine = got.filter(pa.array(got["bucket"].to_numpy() < 0))
        return table["chunk"][0].as_py(), Chunk(table, set(mine["bits"].to_pylist()), width, n_buckets)

    def ask(table, got):
        chunk, c = open_(table, got)
        release()
        return c.ask(chunk)

    def finish(table, got):
        _, c = open_(table, got)
        rest = got.filter(pa.array(got["bucket"].to_numpy() >= 0))
        out = c.candidates(dict(zip(rest["bucket"].to_pylist(), rest["bits"].to_pylist())))
        release()
        return out

    shared = (by_chunk.cogroup(reps.groupBy("chunk")).applyInArrow(ask, ASK)
              .groupBy("bucket").applyInArrow(judge, "chunk int, bucket int, bits binary"))
    return by_chunk.cogroup(reps.unionByName(shared).groupBy("chunk")).applyInArrow(
        finish, "cls binary, n long, home long, prefix array<long>, items binary")


def _blocks(df: DataFrame, key: str, max_group: int) -> DataFrame:
    """``df`` plus ``_parts``: into how many parts its group is split."""
    big = materialize(df.groupBy(F.col(key).alias("_k")).count().filter(F.col("count") > max_group)
                      .select("_k", F.ceil(F.col("count") / max_group).cast("int").alias("_p")))
    few = big.count() <= 100_000                              # at most rows / max_group of them
    return df.join(F.broadcast(big) if few else big, F.col(key) == F.col("_k"), "left") \
             .withColumn("_parts", F.coalesce("_p", F.lit(1))).drop("_k", "_p")


def _part(salt: str):
    return F.pmod(F.xxhash64("cls", F.lit(salt)), F.col("_parts")).cast("int")


def _labels(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with label, star edges) after joining along the edges."""
    comp = components(edges)
    stars = comp.select(F.col("node").alias("a"), F.col("root").alias("b"))
    out = nodes.join(comp, F.col("cls") == F.col("node"), "left")
    return materialize(out.select("cls", "prefix", F.coalesce("root", "cls").alias("label"))), stars


def _tokens(labelled: DataFrame) -> DataFrame:
    return labelled.select(F.explode("prefix").alias("token"), "cls", "label")


def _open(labelled: DataFrame) -> DataFrame:
    """Prefix shingles that classes of different components hold: one class of
    two of the components, and the leader."""
    m = F.struct("label", "cls")
    return _tokens(labelled).groupBy("token").agg(F.min(m).alias("x"), F.max(m).alias("y"), F.min(F.xxhash64("cls")).alias("leader")) \
        .filter("x.label != y.label")


def _check_pairs(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    ia = items.select(F.col("cls").alias("a"), F.col("items").alias("x"))
    ib = items.select(F.col("cls").alias("b"), F.col("items").alias("y"))

    def check(batches):
        for batch in batches:
            ok = [links(np.frombuffer(x, U64), np.frombuffer(y, U64)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(ia, "a").join(ib, "b").select("a", "b", "x", "y").mapInArrow(check, EDGE)


def class_links(cand: DataFrame, max_group: int = 4096, rounds: int = 2) -> DataFrame:
    """(node, root) components of the candidate classes."""
    nodes, items = cand.select("cls", "prefix"), cand.select("cls", "items")
    group = _blocks(cand.select("cls", "home", "items"), "home", max_group).withColumn("_part", _part("home"))
    edges = group.groupBy("home", "_part").applyInArrow(tree_links, EDGE)
    labelled, stars = _labels(nodes, edges)
    if group.filter("_parts > 1").isEmpty():
        rounds = 0
    for _ in range(rounds):
        pairs = _open(labelled).groupBy(F.col("x.label").alias("p"), F.col("y.label").alias("q")) \
            .agg(F.min(F.struct(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))).alias("ab")).select("ab.*")
        pairs = materialize(pairs.distinct())
        if pairs.isEmpty():
            break
        labelled, stars = _labels(nodes, stars.unionByName(_check_pairs(pairs, items)))
    members = _tokens(labelled).join(_open(labelled).select("token", "leader"), "token").select("cls", "label", "leader").distinct()
    members = _blocks(materialize(members), "leader", max_group).withColumn("_part", _part("open"))
    # a member of part i meets every part j: one group for each pair of parts
    pair = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1),
                       lambda j: F.struct(F.least(j, F.col("_part")).alias("lo"), F.greatest(j, F.col("_part")).alias("hi")))
    meet = members.withColumn("pair", F.explode(pair)).withColumn("side", F.col("_part"))
    full = meet.join(items, "cls").select("leader", "pair", "side", "cls", "label", "items")
    edges = full.groupBy("leader", "pair").applyInArrow(tree_links, EDGE)
    return components(stars.unionByName(edges))


def components_of(docs: DataFrame, width: int = 5, max_group: int = 4096) -> DataFrame:
    """doc_id, t, n, cls, root of every row: the class of its set and the class
    that names its component (null for rows without shingles)."""
    rows = materialize(class_rows(docs, width))
    classes = materialize(rows.groupBy("cls", "n").agg(F.min("doc_id").alias("doc_id")))
    cand = materialize(candidates(docs, classes, width))
    roots = materialize(class_links(cand, max_group))            # only classes that link with another
    named = materialize(rows.join(roots, (F.col("cls") == F.col("node")) & (F.col("n") > 0), "left")
                        .select("doc_id", "t", "n", "cls", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root")))
    return named


def jaccard_components(docs: DataFrame, width: int = 5, max_group: int = 4096) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the component) for each row.

    Null or empty text: n_shingles 0, alone. Null ids count as larger than all
    others: a component's id is null only if all its ids are. Rows with equal
    sets are in one component, repeated rows too; ids need not be unique. Reads
    doc_id and text only. Empty table: no rows.
    """
    named = components_of(docs, width, max_group)
    least = materialize(named.filter("n > 0").groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("least")))
    return named.join(least, F.col("root") == F.col("_root"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, width: int = 5, max_group: int = 4096) -> DataFrame:
    """The row of smallest id (then text hash) of each component, all columns; rows
    without shingles all stay. Of rows that repeat entirely one stays."""
    named = components_of(docs, width, max_group)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "t")
    keep = named.filter("n > 0").groupBy("root").agg(F.min(key).alias("k")).select("k.*") \
        .unionByName(named.filter("n = 0").select(key.alias("k")).select("k.*").distinct())
    keep = materialize(keep.select(F.col("no_id").alias("_no"), F.col("id").alias("_id"), F.col("t").alias("_t")))
    mine = [F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64("text")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_r"),
                       *[c.alias(n) for c, n in zip(mine, ("_no", "_id", "_t"))]).join(keep, ["_no", "_id", "_t"], "left_semi")
    again = F.row_number().over(Window.partitionBy("_no", "_id", "_t").orderBy(F.lit(1)))
    blank = F.col("_r.text").isNull() | (F.translate("_r.text", " \t\n\x0b\x0c\r", "") == "")
    return rows.withColumn("_n", again).filter((F.col("_n") == 1) | blank).select("_r.*")


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
