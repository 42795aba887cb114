"""A history is cut to the kept keys below its first exchange, and no key is lost."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from visitmart.operators.keyfilter import cut_to_keys, key_bitmaps
from visitmart.operators.schedule import first_diagnosis


def _history(spark, folder, n=20_000):
    h = spark.range(n).select((F.col("id") % 1000).alias("pat_id1"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))
                              .alias("appt_date"), F.col("id").cast("string").alias("diag_code"), F.lit("x").alias("diag_desc"))
    h.write.parquet(f"{folder}/history")
    return spark.read.parquet(f"{folder}/history")


def _above(plan: str, leaf: str) -> list[str]:
    """The nodes above a leaf of a printed plan, nearest first."""
    lines = [(len(re.match(r"[ :+|-]*", x).group()), x) for x in plan.splitlines() if x.strip()]
    at = next(i for i, (_, x) in enumerate(lines) if "FileScan" in x and leaf in x)
    depth, out = lines[at][0], []
    for d, x in reversed(lines[:at]):
        if d < depth:
            depth = d
            out.append(x)
    return out


@pytest.mark.parametrize("limit", ["-1", "33554432"])
def test_no_exchange_of_the_uncut_history(spark, tmp_dir, limit):
    history = _history(spark, tmp_dir)
    spark.range(5, 9).select(F.col("id").alias("pat_id1")).write.parquet(f"{tmp_dir}/keys")
    keys = spark.read.parquet(f"{tmp_dir}/keys")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        out = first_diagnosis(history, keys)
        nodes = _above(out._jdf.queryExecution().sparkPlan().toString(), "diag_code")
        executed = _above(out._jdf.queryExecution().executedPlan().toString(), "diag_code")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    cut = next(i for i, x in enumerate(nodes) if "LeftSemi" in x)
    assert "BroadcastHashJoin" in nodes[cut] and "_bucket" in nodes[cut]
    assert not any("HashAggregate" in x for x in nodes[:cut])
    cut = next(i for i, x in enumerate(executed) if "_bucket" in x and "LeftSemi" in x)
    assert not any("Exchange" in x for x in executed[:cut])
    want = history.filter("pat_id1 between 5 and 8").groupBy("pat_id1").agg(F.min(F.struct("appt_date", "diag_code")).alias("m"))
    assert rows(out, "pat_id1", "dx_code") == rows(want.select("pat_id1", F.col("m.diag_code").alias("dx_code")), "pat_id1", "dx_code")


@pytest.mark.parametrize("bits", [1 << 15, 1 << 18, 1 << 26])
def test_no_key_is_lost_and_few_others_pass(spark, bits):
    keys = spark.range(0, 30_000, 3).select(F.col("id").alias("k"))
    history = spark.range(-100, 30_000).select(F.col("id").alias("k"))
    got = {r.k for r in cut_to_keys(history, keys, "k", bits).collect()}
    assert set(range(0, 30_000, 3)) <= got
    others = len(got) - 10_000
    assert others <= 1.2 * 20_100 * 10_000 / bits + 5
    assert key_bitmaps(keys, "k", bits).count() <= bits // 32_768


def test_nulls_widths_texts_and_no_keys(spark):
    history = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "k int, s string")
    long_keys = spark.createDataFrame([(2,), (None,)], "k long")
    assert rows(cut_to_keys(history, long_keys, "k")) == [(2, "b")]
    assert rows(cut_to_keys(history, spark.createDataFrame([("a",)], "s string"), "s")) == [(1, "a")]
    assert cut_to_keys(history, long_keys.filter("false"), "k").count() == 0
    assert cut_to_keys(history, spark.createDataFrame([("2",)], "k string"), "k").count() == 3      # not comparable: uncut
