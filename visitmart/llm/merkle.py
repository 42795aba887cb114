"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf; the rows of a ``tree`` value (``lang``) form a binary tree in
id order, and the subroots, in order of that value, form the top tree. A node is
known by its coordinate (tree, level, index).

Leaves are sorted into parts by range, so a part holds consecutive leaves and a
large tree spans many parts. A part folds its leaves as far as they go and
publishes the nodes whose parent it cannot finish: two a level at most. Those
are raised to the root in strata of 12 levels, 4,096 nodes to a group.

Proofs are made part by part (the octopus multiproof): the paths of all leaves of
a part overlap, so only the union of the siblings that none of its own leaves
derive has to come from outside. A part computes those coordinates, fetches
them in one join, derives the shared interior nodes once, up to the root, and
expands every single proof from them. Any missing sibling is a published
node, so the table of published nodes (some rows a part and level) is all that
is kept of the tree.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordered import before, in_order, running

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STRATUM = 12
TOP = -1                                  # the tree of the subroots


# -- trees -------------------------------------------------------------------

def parent(*children: bytes) -> bytes:
    """Digests are lowercase hex text."""
    return sha256(b"".join(children)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return (n - 1).bit_length() if n else 0


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree of n leaves."""
    return -(-n >> level)


def published(leaves: list[bytes], first: int, n: int) -> list[tuple[int, int, bytes]]:
    """(level, index, digest) of the nodes over ``leaves``, the leaves first,
    first + 1, ... of a tree of n, whose parent has other leaves too, or the root."""
    out, level, a, row = [], 0, first, leaves
    while row:
        size, b = width(n, level), a + len(row)
        if size == 1:
            out.append((level, a, row[0]))
            break
        if b % 2 and b != size:
            out.append((level, b - 1, row.pop()))
        if a % 2 and row:
            out.append((level, a, row.pop(0)))
            a += 1
        row = [parent(*row[i:i + 2]) for i in range(0, len(row), 2)]
        a, level = a // 2, level + 1
    return out


def raise_group(nodes: dict[tuple[int, int], bytes], n: int, top: int) -> list[tuple[int, int, bytes]]:
    """New nodes, up to level ``top`` or the root, over nodes that cover a node of that level."""
    out = []
    for level in range(min(level for level, _ in nodes), min(top, height(n))):
        for i in sorted(i // 2 for lv, i in nodes if lv == level and i % 2 == 0):
            pair = [nodes[level, j] for j in (2 * i, 2 * i + 1) if j < width(n, level)]
            nodes[level + 1, i] = parent(*pair)
            out.append((level + 1, i, nodes[level + 1, i]))
    return out


def missing(index: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Octopus: coordinates (level, index) that the paths of these leaves need and
    that the leaves themselves do not derive."""
    out, index = [], np.unique(index)
    for level in range(height(n)):
        need = np.setdiff1d(index ^ 1, index)
        out += [(level, i) for i in need[need < width(n, level)].tolist()]
        index = np.unique(index >> 1)
    return out


class Paths:
    """All nodes on the paths of some leaves of a tree: own leaves, fetched siblings
    and the interior nodes derived from both, each once."""

    def __init__(self, leaves: dict[int, bytes], fetched: dict[tuple[int, int], bytes], n: int):
        self.n, self.levels, on = n, [], leaves
        by_level: dict[int, dict[int, bytes]] = {}
        for (level, i), digest in fetched.items():
            by_level.setdefault(level, {})[i] = digest
        for level in range(height(n)):
            have = {**on, **by_level.get(level, {})}
            self.levels.append(have)
            last = width(n, level) - 1
            on = {p: parent(*([have[2 * p], have[2 * p + 1]] if 2 * p < last else [have[2 * p]])) for p in {i >> 1 for i in on}}
        self.root = on[0]

    def siblings(self, i: int) -> list[bytes | None]:
        """The sibling at each level (None: the node stands alone)."""
        out = []
        for have in self.levels:
            out.append(have.get(i ^ 1))
            i >>= 1
        return out


def fold(digest: bytes, i: int, siblings: list[bytes | None]) -> bytes:
    """The root that a leaf and its siblings give."""
    for s in siblings:
        digest = parent(digest) if s is None else parent(s, digest) if i & 1 else parent(digest, s)
        i >>= 1
    return digest


# -- the manifest ------------------------------------------------------------

NODE = "t long, level int, index long, digest binary"


def _nodes(rows: list, t: list) -> pa.Table:
    return pa.table({"t": pa.array(t, pa.int64()), "level": pa.array([r[0] for r in rows], pa.int32()),
                     "index": pa.array([r[1] for r in rows], pa.int64()), "digest": pa.array([r[2] for r in rows], pa.binary())})


def _hex(column) -> list[bytes]:
    return [x.hex().encode() for x in column.to_pylist()]


def publish(rows: pa.Table, runs: pa.Table) -> pa.Table:
    """The published nodes of a part."""
    leaves = _hex(rows.sort_by("at")["leaf"])
    out, t = [], []
    for run in runs.to_pylist():
        got = published(leaves[run["first"]:run["first"] + run["n"]], run["start"], run["total"])
        out += got
        t += [run["t"]] * len(got)
    return _nodes(out, t)


IS_ROOT = "index = 0 AND shiftright(total - 1, level) = 0 AND (level = 0 OR shiftright(total - 1, level - 1) > 0)"


def _lift(top: int):
    def lift(table: pa.Table) -> pa.Table:
        at = zip(table["level"].to_pylist(), table["index"].to_pylist())
        new = raise_group(dict(zip(at, table["digest"].to_pylist())), table["total"][0].as_py(), top)
        return _nodes(new, [table["t"][0].as_py()] * len(new))

    return lift


def raise_nodes(nodes: DataFrame, totals: DataFrame, stratum: int = STRATUM) -> DataFrame:
    """``nodes`` (t, level, index, digest) of trees with ``total`` leaves plus all nodes above."""
    most = totals.agg(F.max("total")).first()[0] or 0
    sized = lambda df: df.join(totals.select("t", "total"), "t").filter(f"NOT ({IS_ROOT})")
    out, open_ = nodes, sized(nodes)
    for top in range(stratum, height(most) + stratum, stratum):
        block = F.expr(f"shiftright(index, {top} - level)").alias("block")
        new = materialize(open_.filter(F.col("level") < top).groupBy("t", block).applyInArrow(_lift(top), NODE))
        out = out.unionByName(new)
        open_ = open_.filter(F.col("level") >= top).unionByName(sized(new.filter(F.col("level") == top)))
    return out


def ask(runs: pa.Table) -> pa.Table:
    """The nodes a part must fetch, in the trees of its leaves and in the top tree."""
    out, t = [], []
    for run in runs.to_pylist():
        got = missing(np.arange(run["start"], run["start"] + run["n"]), run["total"])
        out += got
        t += [run["t"]] * len(got)
    got = missing(runs["t"].to_numpy(), runs["trees"][0].as_py())
    return pa.table({"part": pa.array([runs["part"][0].as_py()] * len(out + got), pa.int32()), "t": pa.array(t + [TOP] * len(got), pa.int64()),
                     "level": pa.array([r[0] for r in out + got], pa.int32()), "index": pa.array([r[1] for r in out + got], pa.int64())})


PROOF = ("doc_id long, position long, tree_size long, leaf string, subroot string, root string, proof binary, proof_sha256 string, "
         "folded_root string, verified boolean")


def _expand(with_proofs: bool):
    def expand(rows: pa.Table, info: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        ids, leaves, altered = rows["id"].to_pylist(), _hex(rows["leaf"]), rows["altered"].to_pylist()
        runs, fetched = [], {}
        for x in info.to_pylist():
            if x["digest"] is None:
                runs.append(x)
            else:
                fetched.setdefault(x["t"], {})[x["level"], x["index"]] = x["digest"]
        trees = {x["t"]: Paths(dict(zip(range(x["start"], x["start"] + x["n"]), leaves[x["first"]:x["first"] + x["n"]])),
                               fetched.get(x["t"], {}), x["total"]) for x in runs}
        top = Paths({t: p.root for t, p in trees.items()}, fetched.get(TOP, {}), runs[0]["trees"]) if runs else None
        cols: list[list] = [[] for _ in range(10)]
        for x in runs:
            t, above, root, subroot = x["t"], top.siblings(x["t"]), x["root"].decode(), x["subroot"].decode()
            for k in range(x["n"]):
                r, pos = x["first"] + k, x["start"] + k
                own = trees[t].siblings(pos)
                proof = b"".join(s for s in own + above if s is not None)
                # An unaltered leaf folds to what the shared interior nodes, derived here, give.
                folded = top.root if altered[r] is None else fold(fold(altered[r].hex().encode(), pos, own), t, above)
                folded = folded.decode()
                for col, value in zip(cols, (ids[r], pos, x["total"], leaves[r].decode(), subroot, root, proof if with_proofs else None,
                                             sha256(proof).hexdigest(), folded, folded == root)):
                    col.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.bool_())
        return pa.table({f.split()[0]: pa.array(c, k) for f, c, k in zip(PROOF.split(", "), cols, kinds)})

    return expand


def leaf_digest(fields: list[Column]) -> Column:
    """sha256 (binary) of the fields: ``-`` for null, else byte count, ``:`` and value."""
    text = [c.cast("string") for c in fields]
    coded = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in text]
    return F.unhex(F.sha2(F.concat(*coded).cast("binary"), 256))


def manifest(docs: DataFrame, fields: tuple = FIELDS, id_col: str = "doc_id", tree_col: str = "lang",
             altered: tuple[Column, dict[str, Column]] | None = None, with_proofs: bool = False, rows_per_part: int = 50_000,
             stratum: int = STRATUM) -> DataFrame:
    """doc_id, position, tree_size, leaf, subroot, root, proof, proof_sha256, folded_root, verified for each row.

    ``proof`` (only ``with_proofs``; else null) holds the siblings' digests as hex
    text, leaf upward, without the levels where a node stands alone; position and
    tree_size tell those. ``altered``: (which rows, replaced columns) gives rows
    another leaf at verification; all other rows verify unless the manifest is wrong.

    Nulls: a null field is ``-``; a null tree value is a tree of its own, the first;
    null ids come first in their tree and are equal. Rows of equal id stand in order
    of their leaf digests; rows that repeat entirely are leaves each, with the same
    digest and different proofs. Empty text: ``0:``. Very long texts are hashed in
    the JVM and never reach Python. Empty table: no rows. Columns not in ``fields``
    are not read, whatever their names.
    """
    col = {f: F.col(f"`{f}`") for f in {*fields, id_col, tree_col}}
    change = F.lit(None).cast("binary")
    if altered is not None:
        change = F.when(altered[0], leaf_digest([altered[1].get(f, col[f]) for f in fields]))
    leaves = materialize(docs.select(
        col[id_col].cast("long").alias("id"), F.coalesce(F.concat(F.lit("1"), col[tree_col].cast("string")), F.lit("0")).alias("tree"),
        leaf_digest([col[f] for f in fields]).alias("leaf"), change.alias("altered"), F.monotonically_increasing_id().alias("row")))
    rows = in_order(leaves, ["tree", "id", "leaf", "row"], leaves.count(), rows_per_part)
    runs = materialize(before(rows.groupBy("part", "tree").agg(F.count("*").alias("n"), F.min("at").alias("first")), "tree"))
    totals = runs.groupBy("tree").agg(F.sum("n").alias("total"), F.lit(1).alias("one"))
    trees = totals.count()
    numbers = materialize(running(totals, ["tree"], "one", trees, rows_per_part).select("tree", F.col("start").alias("t"), "total"))
    runs = materialize(runs.join(numbers.select("tree", "t"), "tree").select("part", "t", "first", "n", "start", "total")
                       .withColumn("trees", F.lit(trees).cast("long")))
    by_part = rows.select("part", "at", "id", "leaf", "altered").groupBy("part")

    nodes = materialize(by_part.cogroup(runs.groupBy("part")).applyInArrow(publish, NODE))
    nodes = raise_nodes(nodes, numbers, stratum)
    roots = materialize(nodes.join(numbers.select("t", "total"), "t").filter(IS_ROOT).select("t", F.col("digest").alias("subroot")))
    tops = roots.select(F.lit(TOP).cast("long").alias("t"), F.lit(0).alias("level"), F.col("t").alias("index"), F.col("subroot").alias("digest"))
    tops = raise_nodes(tops, docs.sparkSession.range(1).select(F.lit(TOP).cast("long").alias("t"), F.lit(trees).cast("long").alias("total")), stratum)
    root = tops.agg(F.max_by("digest", "level")).first()[0] or b""

    asked = runs.groupBy("part").applyInArrow(ask, "part int, t long, level int, index long")
    got = asked.join(nodes.unionByName(tops), ["t", "level", "index"])
    mine = runs.join(roots, "t").withColumn("root", F.lit(bytearray(root)))
    info = materialize(mine.unionByName(got, allowMissingColumns=True))
    return by_part.cogroup(info.groupBy("part")).applyInArrow(_expand(with_proofs), PROOF)


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Where 7 divides crc32(doc_id), n_chars is one larger at verification."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    out = manifest(docs, altered=(hit, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# crc32 over the decimal digits, bit by bit; levels by a recursive query, a node alone in its run hashed alone.
OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents),
codes AS (
  SELECT doc_id, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                               lambda x, z: xor(x >> 1, (x & 1) * 3988292384))) AS inv
  FROM documents),
leaves AS (
  SELECT d.doc_id, d.lang, pos,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || tail) AS used
  FROM (SELECT d.*, n_chars + CASE WHEN xor(inv, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS m FROM d JOIN codes USING (doc_id)) d),
low AS (
  SELECT lang, 0 AS lv, pos AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS w FROM leaves
  UNION ALL
  SELECT lang, any_value(lv) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(w) + 1) // 2
  FROM low WHERE w > 1 GROUP BY lang, i // 2),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM low WHERE w = 1),
high AS (
  SELECT 0 AS lv, t AS i, subroot AS h, count(*) OVER () AS w FROM subs
  UNION ALL
  SELECT any_value(lv) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(w) + 1) // 2
  FROM high WHERE w > 1 GROUP BY i // 2),
steps AS (
  SELECT l.doc_id, n.lv AS step, l.pos >> n.lv AS at, s.h FROM leaves l
  JOIN low n ON n.lang IS NOT DISTINCT FROM l.lang AND n.w > 1 AND n.i = l.pos >> n.lv
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lv = n.lv AND s.i = xor(n.i, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + n.lv, t.t >> n.lv, s.h FROM leaves l JOIN subs t ON t.lang IS NOT DISTINCT FROM l.lang
  JOIN high n ON n.w > 1 AND n.i = t.t >> n.lv LEFT JOIN high s ON s.lv = n.lv AND s.i = xor(n.i, 1)),
path AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS k FROM steps),
proofs AS (SELECT doc_id, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256, count(*) AS n FROM steps GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0::BIGINT AS k, used AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, p.k, sha256(CASE WHEN p.h IS NULL THEN f.h WHEN p.at % 2 = 1 THEN p.h || f.h ELSE f.h || p.h END)
  FROM folds f JOIN path p ON p.doc_id = f.doc_id AND p.k = f.k + 1),
top AS (SELECT h AS root FROM high WHERE w = 1)
SELECT l.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves l JOIN subs s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN top
LEFT JOIN proofs p ON p.doc_id = l.doc_id JOIN folds f ON f.doc_id = l.doc_id AND f.k = coalesce(p.n, 0)
"""
