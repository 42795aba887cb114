"""Sinks: CSV export, datamart full refresh, and append loads.

* ``export_csv`` writes an extract the way the extract tool does: fields as
  the query made them (the query already quoted free text), header first, the
  list's order kept where it is named; ``read_export`` gives the lines in order.
* ``refresh`` replaces a datamart without the source's "truncate, then
  insert" gap: every run writes a new ``version=<id>`` directory under the
  target, and only after the write has succeeded is the version logged.
  A failed run leaves the previous version current; readers of the old
  version are never cut off, and a table is never overwritten while it is
  being read.
* ``append`` adds rows as a committed batch. As in the source a rerun appends
  again; with ``dedup_keys`` rows whose keys are already present are skipped,
  which makes reruns idempotent. ``streaming.append_stream`` writes the same way.
* Rejected rows of every load go to a folder next to the target. Rows and rejects
  become visible together, by the one log entry of their version or batch; a load
  that dies between the two writes shows neither.

All paths must be on the cluster's shared storage; ``scratch_dir`` derives
one from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, file_status, remove_old
from . import charset as charsets
from .csvload import Loaded

VERSION_LOG = "_versions"
BATCH_LOG = "_batches"
REJECTS = "_rejects"
MANIFEST = "_manifest"


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "visitmart", *parts, uuid.uuid4().hex])


def export_csv(df: DataFrame, path: str, null_value: str = "NULL", preamble: bool = True, charset: str = charsets.DEFAULT,
               headers: dict | None = None, order_by: list[str | Column] | None = None) -> str:
    """Write an extract as the extract tool does: comma-joined text lines,
    ``NULL`` for NULL, no quoting of our own (the query quoted free text
    where it wanted to), preceded by a header line and a dash rule.

    ``headers`` gives columns another name in the file, for instance one with
    blanks (``{"EDIT_DATE": "EDIT DATE"}``). Characters the charset lacks are
    written as ``?``; use UTF-8 where that matters.

    ``order_by`` (names or sort columns) keeps the list's order: rows are sorted
    by range partitions, ties by the text of the line, so a large group of ties is
    split too (equal lines stay together). Part files in name order, as the manifest lists
    them, are the list, after a first part with the preamble alone; ``read_export``
    reads them so, and joining the parts gives the extract tool's one file. Without
    it rows come in any order, with the preamble in one of the parts; the loader
    recognises it by content.
    """
    spark = df.sparkSession
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_value))
                              for c in df.columns]).alias("value")
    if order_by:
        keys = [F.col(f"`{k}`") if isinstance(k, str) else k for k in order_by]
        out = df.withColumn("_line", line).orderBy(*keys, F.col("_line")).select(F.col("_line").alias("value"))
    else:
        out = df.select(line)
    if preamble:
        names = [(headers or {}).get(c, c) for c in df.columns]
        head = [",".join(names), ",".join("-" * max(len(c), 1) for c in names)]
        # A union's partitions are those of its sides in turn, and parts are named by partition.
        out = spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).unionByName(out)
    # The CSV writer with one column, no separator in use and no quoting: plain lines in any charset.
    (out.select(charsets.before_write(F.col("value"), charset).alias("value"))
        .write.mode("errorifexists").option("encoding", charsets.spark_name(charset)).option("sep", "\u0001").option("quote", "")
        .option("escapeQuotes", "false").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", "").option("lineSep", "\r\n").csv(path))
    if order_by:
        parts = sorted((name, size) for name, size in file_status(spark, path) if name.startswith("part-"))
        listed = [(json.dumps({"part": i, "file": name, "bytes": size}),) for i, (name, size) in enumerate(parts)]
        spark.createDataFrame(listed, "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/{MANIFEST}")
    return path


def read_export(spark: SparkSession, path: str, charset: str = charsets.DEFAULT) -> DataFrame:
    """line_no (from 1) and line of an ordered export, preamble included.

    Lines are counted per split of a part; the prefix sum runs over one row a split,
    and each line's number within its split over the split alone, so no task
    holds more than a split. Fields must not hold line breaks.
    """
    listed = spark.read.text(f"{path}/{MANIFEST}").select(F.from_json("value", "part long, file string").alias("m")).select("m.*")
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.regexp_replace(charsets.after_read(F.decode(F.col("value").cast("binary"), charsets.spark_name(charset)), charset), "\r$", "").alias("line"),
        F.monotonically_increasing_id().alias("_seq"))
    sizes = text.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n")).join(listed, "file")
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part", "split")) - F.col("n")).select("file", "split", "before")
    place = F.row_number().over(Window.partitionBy("file", "split").orderBy("_seq"))
    return (text.withColumn("place", place).join(before, ["file", "split"])
            .select((F.col("before") + F.col("place")).alias("line_no"), "line"))


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f") + uuid.uuid4().hex[:6]


def refresh(df: DataFrame, target: str, version: str | None = None, rejects: DataFrame | None = None) -> str:
    """J9/J21 full refresh: write a new version, then log it as committed.

    The version log only ever grows by appended files, each committed by its
    own job, so a run that dies at any point leaves the previous version
    current. Version ids sort by time. ``rejects`` are committed with the rows.
    """
    version = version or new_version()
    df.write.mode("errorifexists").parquet(f"{target}/version={version}")
    if rejects is not None:
        write_rejects(rejects, target, "r" + version)
    log_commit(df.sparkSession, f"{target}/{VERSION_LOG}", "version", version)
    return version


def log_commit(spark: SparkSession, log: str, column: str, name: str) -> None:
    spark.createDataFrame([(name,)], f"{column} string").coalesce(1).write.mode("append").parquet(log)


def current_version(spark: SparkSession, target: str) -> str:
    """The newest committed version (one small aggregate over the log)."""
    return spark.read.parquet(f"{target}/{VERSION_LOG}").agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The current version of a refreshed datamart."""
    return spark.read.parquet(f"{target}/version={current_version(spark, target)}")


def remove_old_versions(spark: SparkSession, target: str, older_than_hours: float = 48) -> list[str]:
    """Delete superseded versions of a refreshed datamart after a retention time."""
    return remove_old(spark, target, older_than_hours, keep=(f"version={current_version(spark, target)}",))


# -- append tables -------------------------------------------------------------
# An append table is a folder of batches and a log of the batches committed. Batch
# loads and streams write it the same way, so feeds of both kinds can share one
# table, a failed write is never read, and a stream batch that runs again
# replaces its own folder.

def commit_batch(df: DataFrame, target: str, batch: str, rejects: DataFrame | None = None) -> None:
    """Write one batch and its rejects, then log it. Writing the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")
    if rejects is not None:
        write_rejects(rejects, target, batch)
    log_commit(df.sparkSession, f"{target}/{BATCH_LOG}", "batch", batch)


def has_log(spark: SparkSession, target: str, log: str) -> bool:
    return bool(file_status(spark, f"{target}/{log}"))


def read_table(spark: SparkSession, target: str, without: str | None = None) -> DataFrame:
    """The rows of all committed batches, but for the one named ``without``."""
    log = spark.read.schema("batch string").parquet(f"{target}/{BATCH_LOG}").distinct()
    if without is not None:
        log = log.filter(F.col("batch") != without)
    return spark.read.parquet(target).join(log, "batch", "left_semi").drop("batch")


def append(df: DataFrame, target: str, dedup_keys: list[str] | None = None,
           exists: bool = True, batch: str | None = None, rejects: DataFrame | None = None) -> DataFrame:
    """J22 append load; optionally skip rows whose keys are already loaded.

    Keys compare null-safe, and of rows with equal keys inside the batch one is
    loaded, so a rerun adds nothing. A batch that runs again is compared with the
    other batches only. ``exists=False`` tells the first load that there is nothing
    to compare with yet.
    """
    out, batch = df, batch or "b" + new_version()
    if dedup_keys:
        out = df.dropDuplicates(dedup_keys)
        if exists and has_log(df.sparkSession, target, BATCH_LOG):
            present = read_table(df.sparkSession, target, without=batch).select(
                *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(dedup_keys)])
            same = F.lit(True)
            for i, k in enumerate(dedup_keys):
                same = same & out[f"`{k}`"].eqNullSafe(F.col(f"_k{i}"))
            out = out.join(present, same, "left_anti")
    commit_batch(out, target, batch, rejects)
    return out


# -- loads ---------------------------------------------------------------------

def write_rejects(rejects: DataFrame, target: str, load: str) -> None:
    """Put a load's rejected rows next to the target; they are read once the load is logged."""
    rejects.write.mode("overwrite").parquet(f"{target}{REJECTS}/load={load}")


def read_rejects(spark: SparkSession, target: str) -> DataFrame:
    """The rejected rows of all committed loads, with the load's name as ``_load``."""
    loads = [spark.read.schema(f"{column} string").parquet(f"{target}/{log}").select(F.concat(F.lit(mark), F.col(column)).alias("_load"))
             for log, column, mark in ((VERSION_LOG, "version", "r"), (BATCH_LOG, "batch", "")) if has_log(spark, target, log)]
    named = loads[0] if len(loads) == 1 else loads[0].unionByName(loads[1])
    return spark.read.parquet(f"{target}{REJECTS}").withColumnRenamed("load", "_load").join(named.distinct(), "_load", "left_semi")


def load_refresh(loaded: Loaded, target: str) -> str:
    """Refresh the target with the rows and set the rejects aside, in one commit."""
    loaded = loaded.once()
    return refresh(loaded.rows, target, rejects=loaded.rejects)


def load_append(loaded: Loaded, target: str, batch: str | None = None, **kw) -> None:
    """Append the rows and set the rejects aside, in one commit."""
    loaded = loaded.once()
    append(loaded.rows, target, batch=batch, rejects=loaded.rejects, **kw)
