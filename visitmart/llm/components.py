"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _mark(edges: DataFrame):
    r = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of any ordered type -> (node, root), root the least node of
    the component, for every node but the roots themselves. The table is
    written after each round, so lineage stays short; rounds grow with the
    logarithm of the component size."""
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u != v").distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("k"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        e = materialize(small.filter("u != v").distinct())
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
