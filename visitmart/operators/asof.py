"""Strict backward as-of lookup on calendar days.

"For each (patient, day), the latest qualifying history day strictly
before it." The source writes a correlated ``TOP 1 ... ORDER BY DESC``
subquery per output row; decorrelated naively that becomes an inequality
join of every target with every earlier history row of the patient.

Here both sides are first reduced to distinct (patient, day) keys, with
map-side aggregation. A patient then holds at most one row per calendar day
on each side, whatever the number of raw rows behind it, so the group of
even the hottest patient is bounded by the calendar. The two key sets are
unioned and one window (range frame ending one day before the current
row) carries the latest history day forward. No pairs are produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def strict_backward_asof(targets: DataFrame, history: DataFrame, key: str = "pat_id1",
                         day: str = "day", out: str = "last_day") -> DataFrame:
    """Return distinct (key, day) of ``targets`` with the latest history day < day.

    ``targets`` and ``history`` need columns ``key`` and ``day`` (DATE).
    Targets without an earlier history day get NULL.
    """
    t = targets.select(key, day).distinct().withColumn("_is_target", F.lit(True))
    h = history.select(key, day).distinct().withColumn("_is_target", F.lit(False))
    w = (Window.partitionBy(key)
               .orderBy(F.unix_date(F.col(day)))
               .rangeBetween(Window.unboundedPreceding, -1))
    marked = t.unionByName(h).withColumn(
        out, F.max(F.when(~F.col("_is_target"), F.col(day))).over(w))
    return marked.filter(F.col("_is_target")).select(key, day, out)
