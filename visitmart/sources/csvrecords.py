"""CSV records whose quoted fields hold line breaks, read from splits.

A line break ends a record only outside quotes, and whether a split of a file
starts inside quotes depends on everything before it. Two passes over the splits:

1. Each task runs over its splits' lines once and returns, per split, where the
   split ends up if it starts outside quotes and where if it starts inside: a
   function of one bit. Composed in file order (a window over one row per split)
   they give the state in which each split starts.
2. Each task cuts its splits into records, knowing that state. The lines before a
   split's first record, and its last record if still open, are pieces; pieces of
   one record are joined by (file, split where it starts), in split order.

Only pieces are shuffled, at most two a split. The driver holds the splits that
start inside quotes, a subset of the list of splits it makes when it plans a scan.
Lines end in LF or CR LF (a single CR ends none). A quote opens a field only at the
field's start; text between a closing quote and the next comma belongs to the field.
The last record of a file may be open: it ends with the file. Empty lines outside
quotes are no records; line breaks inside stay as written. Compressed files are one split.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTED = rb'(?:[^"]++|"")*+'
_OPEN = re.compile(rb'(?:"' + _QUOTED + rb'"[^,]*+,|[^",][^,]*+,|,)*+"' + _QUOTED + rb'\Z')
_CLOSED = re.compile(_QUOTED + rb'"[^,]*+(,|\Z)')


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether a line that starts inside or outside quotes ends inside them."""
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSED.match(line)
        if closed is None:
            return True
        at = closed.end()
    return _OPEN.match(line, at) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all splits as bytes, in file order within each split."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       F.col("value").cast("binary").alias("line"))


def _runs(batches):
    """(file, split, lines) of consecutive lines of one split, batch by batch."""
    for b in batches:
        files, splits, lines = (b.column(i).to_pylist() for i in range(3))
        a = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or splits[i] != splits[a] or files[i] != files[a]:
                yield (files[a], splits[a]), lines[a:i]
                a = i


def _ends(batches):
    """One row a split: its end state from either start state."""
    at, low, high = None, False, True

    def row():
        return pa.RecordBatch.from_pydict({"file": [at[0]], "split": pa.array([at[1]], pa.int64()),
                                           "low": pa.array([int(low)], pa.int32()), "high": pa.array([int(high)], pa.int32())})

    for key, lines in _runs(batches):
        if key != at:
            if at is not None:
                yield row()
            at, low, high = key, False, True
        for line in lines:
            if b'"' in line:
                low, high = inside_after(line, low), inside_after(line, high)
    if at is not None:
        yield row()


def start_states(ends: DataFrame) -> DataFrame:
    """file, split, and 1 in ``inside`` where the split starts inside quotes.

    A split either sets the state (``low`` = ``high``), keeps it, or flips it: the
    state is the last one set, flipped as often as splits flipped since."""
    order = Window.partitionBy("file").orderBy("split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = ends.withColumn("flips", F.sum((F.col("low") > F.col("high")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last_set = F.last(F.when(F.col("low") == F.col("high"), F.col("low") + F.col("flips")), ignorenulls=True).over(before)
    state = F.coalesce(last_set, F.lit(0)) + F.coalesce(F.max("flips").over(before), F.lit(0))
    return flips.select("file", "split", F.pmod(state, F.lit(2)).cast("int").alias("inside"))


# A whole record, the lines before a split's first record, a record still open at the split's end.
WHOLE, HEAD, TAIL = 0, 1, 2


def _cut(inside: set):
    def cut(batches):
        at, state, held, kind = None, False, [], WHOLE

        def out(rows):
            return pa.RecordBatch.from_pydict({
                "file": pa.array([at[0]] * len(rows), pa.string()), "split": pa.array([at[1]] * len(rows), pa.int64()),
                "kind": pa.array([k for k, _ in rows], pa.int32()), "piece": pa.array([p for _, p in rows], pa.binary())})

        def rest():
            # A split that starts and ends inside without a record of its own is all head.
            return [(HEAD if kind == HEAD else TAIL, b"\n".join(held))] if held else []

        for key, lines in _runs(batches):
            if key != at:
                if at is not None and held:
                    yield out(rest())
                at, state, held = key, key in inside, []
                kind = HEAD if state else WHOLE
            rows = []
            for line in lines:
                state = inside_after(line, state)
                held.append(line)
                if not state:
                    rows.append((kind, b"\n".join(held)))
                    held, kind = [], WHOLE
            if rows:
                yield out(rows)
        if at is not None and held:
            yield out(rest())
    return cut


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the CSV files under ``path``: one ``record`` (bytes) a row."""
    lines = _lines(spark, path)
    ends = lines.mapInArrow(_ends, "file string, split long, low int, high int")
    inside = {(r.file, r.split) for r in start_states(ends).filter("inside = 1").collect()}
    cut = lines.mapInArrow(_cut(inside), "file string, split long, kind int, piece binary")
    whole = cut.filter(F.col("kind") == WHOLE).select(F.col("piece").alias("record"))
    if inside:
        whole = whole.unionByName(_joined(cut.filter(F.col("kind") != WHOLE)))
    else:                                  # a file's last record may still be open
        whole = whole.unionByName(cut.filter(F.col("kind") == TAIL).select(F.col("piece").alias("record")))
    ended = F.when(F.substring("record", -1, 1) == F.lit(b"\r"), F.expr("substring(record, 1, octet_length(record) - 1)")).otherwise(F.col("record"))
    return whole.select(ended.alias("record")).filter(F.octet_length("record") > 0)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records that cross splits: a tail and the heads up to the next tail."""
    order = Window.partitionBy("file").orderBy("split", "kind")
    first = F.last(F.when(F.col("kind") == TAIL, F.col("split")), ignorenulls=True).over(order)
    parts = F.array_sort(F.collect_list(F.struct("split", F.hex("piece").alias("hex"))))
    return (pieces.withColumn("first", first).groupBy("file", "first")
            .agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["hex"]), "0A")).alias("record")).select("record"))
