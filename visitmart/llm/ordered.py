"""Rows in a global order without a task that sees them all: range-sorted parts,
and prefix sums over the parts in two levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def before(runs: DataFrame, key: str, block: int = 1024) -> DataFrame:
    """``runs`` (part, key, n) plus ``start``, the sum of n over smaller parts of the
    key, and ``total``. Summed in two levels, so no task sees all parts of a key."""
    runs = runs.withColumn("_block", F.floor(F.col("part") / block))
    inner = Window.partitionBy(key, "_block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy(key, "_block").agg(F.sum("n").alias("_n"))
    sums = sums.select(key, "_block", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_at"),
                       F.sum("_n").over(Window.partitionBy(key)).alias("total"))
    return runs.withColumn("_in", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(sums, [key, "_block"]) \
        .withColumn("start", F.col("_at") + F.col("_in")).drop("_block", "_in", "_at")


def in_order(df: DataFrame, order: list[str], n_rows: int, rows_per_part: int) -> DataFrame:
    """``df`` sorted into parts by range, written, with ``part`` and ``at``, the place in
    the part. ``df`` must give the same rows whenever it is computed."""
    df = df.repartitionByRange(max(1, -(-n_rows // rows_per_part)), *order).sortWithinPartitions(*order)
    return materialize(df.withColumn("_at", F.monotonically_increasing_id())
                       .withColumn("part", F.shiftright("_at", 33).cast("int"))
                       .withColumn("at", F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at"))


def running(df: DataFrame, order: list[str], size: str, n_rows: int, rows_per_part: int = 50_000) -> DataFrame:
    """``df`` plus ``start``, the sum of ``size`` over the rows before in that order."""
    parts = in_order(df, order, n_rows, rows_per_part).withColumn("_all", F.lit(0))
    inner = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = before(parts.groupBy("_all", "part").agg(F.sum(size).alias("n")), "_all").select("part", F.col("start").alias("_start"))
    return parts.withColumn("_in", F.coalesce(F.sum(size).over(inner), F.lit(0))).join(starts, "part") \
        .withColumn("start", F.col("_start") + F.col("_in")).drop("part", "at", "_all", "_in", "_start")
