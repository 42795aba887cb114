"""CSV loading, refresh, append and the stream loader."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import d, rows, ts
from visitmart.sources import sinks
from visitmart.sources.csvload import LoadSpec, load_csv, mysql_format
from visitmart.session import ensure_checkpoint_dir, materialize, remove_old_temp
from visitmart.streaming.append_stream import stream_append

SPEC = LoadSpec(
    fields=("pat_name", "mrn", "ed", "ad"),
    target=("pat_name", "mrn", "editDate", "apptDate"),
    dates={"editDate": ("ed", "%m/%d/%Y"), "apptDate": ("ad", "%Y-%m-%d %H:%i:%s")},
    header=("PATIENT", "MRN", "EDIT DATE", "APPT"))


def _write(path, lines, sep):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(sep.join(lines).encode("cp1252") + sep.encode())


def test_mysql_formats():
    assert mysql_format("%m/%d/%Y")[1:] == ("M/d/yyyy", False)
    assert mysql_format("%Y%m%d")[1:] == ("yyyyMMdd", False)
    assert mysql_format("%Y-%m-%d %H:%i:%s")[1:] == ("yyyy-M-d H:m:s", True)


def test_load_csv_preamble_quotes_and_rejects(spark, tmp_dir):
    three = ["Changed database context to 'clinic'.", "PATIENT,MRN,EDIT DATE,APPT", "-------,---,---------,----",
             '"DOE, ""JJ""",001,1/5/2024,2024-01-20 09:00:00',
             'caf\xe9 \u201cq\u201d,002,12/30/2023 10:00,2024-01-20 09:00:00.000',   # windows-1252, trailing text
             "NULL,003,bad,2024-01-20 09:00:00",                                  # bad date -> reject
             "SHORT,004",                                                         # short row
             "EXTRA,005,01/02/2024,2024-01-20 09:00:00,zzz"]                      # extra field dropped
    two = ["PATIENT,MRN,EDIT DATE,APPT", "-------,---,---------,----", "LF,006,01/03/2024,2024-01-21 10:00:00"]
    _write(f"{tmp_dir}/in/a.csv", three, "\r\n")
    _write(f"{tmp_dir}/in/b.csv", two, "\n")
    loaded = load_csv(spark, f"{tmp_dir}/in", SPEC)
    assert rows(loaded.rows) == [
        ("DOE, \"JJ\"", "001", d(2024, 1, 5), ts(2024, 1, 20, 9)),
        ("EXTRA", "005", d(2024, 1, 2), ts(2024, 1, 20, 9)),
        ("LF", "006", d(2024, 1, 3), ts(2024, 1, 21, 10)),
        ("SHORT", "004", None, None),
        ("caf\xe9 \u201cq\u201d", "002", d(2023, 12, 30), ts(2024, 1, 20, 9)),
    ]
    rej = loaded.rejects.collect()
    assert [(r.pat_name, r.mrn, r.ed) for r in rej] == [(None, "003", "bad")]


def test_export_then_load_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([('"DOE, JO"', "001", "01/05/2024", "2024-01-20 09:00:00"),
                                (None, "002", "01/06/2024", "2024-01-21 09:00:00")],
                               "PATIENT string, MRN string, `EDIT DATE` string, APPT string")
    sinks.export_csv(df.repartition(3), f"{tmp_dir}/x")
    out = load_csv(spark, f"{tmp_dir}/x", SPEC).rows
    assert rows(out, "pat_name", "mrn") == [("DOE, JO", "001"), (None, "002")]


def test_refresh_is_idempotent_and_keeps_old_version(spark, tmp_dir):
    t = f"{tmp_dir}/mart"
    a = spark.createDataFrame([(1,), (2,)], "x long")
    v1 = sinks.refresh(a, t)
    v2 = sinks.refresh(a, t)
    assert v1 != v2 and sinks.current_version(spark, t) == v2
    assert rows(sinks.read_current(spark, t)) == [(1,), (2,)]
    # the previous version is still readable while the new one is current
    assert spark.read.parquet(f"{t}/version={v1}").count() == 2


def test_append_repeats_unless_dedup(spark, tmp_dir):
    t = f"{tmp_dir}/app"
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    sinks.append(a, t, exists=False)
    sinks.append(a, t)
    assert sinks.read_table(spark, t).count() == 4
    t2 = f"{tmp_dir}/app2"
    sinks.append(a, t2, ["k"], exists=False)
    sinks.append(a, t2, ["k"])
    assert sinks.read_table(spark, t2).count() == 2


def test_stream_append_exactly_once(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _write(f"{land}/day1/a.csv", ["PATIENT,MRN,EDIT DATE,APPT", "A,1,01/05/2024,2024-01-20 09:00:00"], "\r\n")
    tgt, ck = f"{tmp_dir}/tgt", f"{tmp_dir}/ck"
    stream_append(spark, land, SPEC, tgt, ck)
    stream_append(spark, land, SPEC, tgt, ck)
    assert sinks.read_table(spark, tgt).count() == 1
    _write(f"{land}/day2/b.csv", ["B,2,01/06/2024,2024-01-21 09:00:00"], "\n")
    stream_append(spark, land, SPEC, tgt, ck)
    assert rows(sinks.read_table(spark, tgt), "pat_name") == [("A",), ("B",)]


def test_multiline_quoted_field(spark, tmp_dir):
    from dataclasses import replace
    _write(f"{tmp_dir}/m/a.csv", ['PATIENT,MRN,EDIT DATE,APPT', '"DOE,\nJO",7,01/05/2024,2024-01-20 09:00:00'], "\r\n")
    out = load_csv(spark, f"{tmp_dir}/m", replace(SPEC, multiline=True)).rows
    assert rows(out, "pat_name", "mrn", "editDate") == [("DOE,\nJO", "7", d(2024, 1, 5))]


STRICT = LoadSpec(fields=("name", "n", "ed"), target=("name", "n", "day"), dates={"day": ("ed", "%m/%d/%Y")}, types={"n": "bigint"},
                  header=("NAME", "N", "EDIT DATE"))
LINES = ["Changed database context to 'x'.", "name,n,EDIT_DATE", "----,-,---------",      # preamble, two header spellings
         "NULL,NULL,NULL", ",,", "A,1,1/2/2024", "B,notint,1/2/2024", "C,2,13/45/2024", "D,x,bad", "E,,",
         "Changed database context,7,1/2/2024", "-,3,1/2/2024", "NAME,N,EDIT DATE"]


def test_every_data_line_is_a_row_or_a_reject(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", LINES, "\r\n")
    loaded = load_csv(spark, f"{tmp_dir}/in", STRICT)
    assert rows(loaded.rows) == sorted([
        (None, None, None), (None, None, None), ("A", 1, d(2024, 1, 2)), ("E", None, None),
        ("Changed database context", 7, d(2024, 1, 2)), ("-", 3, d(2024, 1, 2))], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(loaded.rejects, "name", "n", "ed", "_failed") == [
        ("B", "notint", "1/2/2024", "n"), ("C", "2", "13/45/2024", "day"), ("D", "x", "bad", "day,n")]


def test_rejects_are_kept_by_batch_and_stream(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", LINES, "\n")
    sinks.load_refresh(load_csv(spark, f"{tmp_dir}/in", STRICT), f"{tmp_dir}/t1")
    assert sinks.read_current(spark, f"{tmp_dir}/t1").count() == 6
    stream_append(spark, f"{tmp_dir}/in", STRICT, f"{tmp_dir}/t2", f"{tmp_dir}/ck")
    assert sinks.read_table(spark, f"{tmp_dir}/t2").count() == 6
    for t in ("t1", "t2"):
        assert rows(sinks.read_rejects(spark, f"{tmp_dir}/{t}"), "name") == [("B",), ("C",), ("D",)]


def test_batch_and_stream_share_a_table(spark, tmp_dir):
    for order in ("bs", "sb"):
        t = f"{tmp_dir}/{order}"
        _write(f"{t}-land/a.csv", ["S,1,1/2/2024"], "\n")
        _write(f"{t}-file/a.csv", ["B,2,1/2/2024"], "\n")
        for step in order:
            if step == "b":
                sinks.load_append(load_csv(spark, f"{t}-file", STRICT), t)
            else:
                stream_append(spark, f"{t}-land", STRICT, t, f"{t}-ck")
                stream_append(spark, f"{t}-land", STRICT, t, f"{t}-ck")
        assert rows(sinks.read_table(spark, t), "name", "n") == [("B", 2), ("S", 1)]


def test_a_batch_that_runs_again_replaces_itself_and_unlogged_ones_are_not_read(spark, tmp_dir):
    a = spark.createDataFrame([(1,)], "x long")
    for _ in range(2):
        sinks.commit_batch(a, f"{tmp_dir}/t", "s1")
    a.write.parquet(f"{tmp_dir}/t/batch=dead")
    assert rows(sinks.read_table(spark, f"{tmp_dir}/t")) == [(1,)]


def test_a_load_that_dies_between_its_writes_shows_neither_rows_nor_rejects(spark, tmp_dir, monkeypatch):
    _write(f"{tmp_dir}/in/a.csv", LINES, "\n")
    loaded = load_csv(spark, f"{tmp_dir}/in", STRICT)
    r, a = f"{tmp_dir}/refreshed", f"{tmp_dir}/appended"
    sinks.load_refresh(loaded, r)
    sinks.load_append(loaded, a)

    def dies(*_):
        raise RuntimeError("lost")

    for name in ("write_rejects", "log_commit"):
        with monkeypatch.context() as m:
            m.setattr(sinks, name, dies)
            for load, target in ((sinks.load_refresh, r), (sinks.load_append, a)):
                with pytest.raises(RuntimeError):
                    load(loaded, target)
        assert sinks.read_current(spark, r).count() == sinks.read_table(spark, a).count() == 6
        assert sinks.read_rejects(spark, r).count() == sinks.read_rejects(spark, a).count() == 3
    sinks.load_append(loaded, a)
    assert sinks.read_table(spark, a).count() == 12 and sinks.read_rejects(spark, a).count() == 6


def test_a_load_parses_its_file_once(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.csv", LINES, "\n")
    once = load_csv(spark, f"{tmp_dir}/in", STRICT).once()
    for df in (once.rows, once.rejects):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_keyed_stream_and_batch_load_an_extract_once(spark, tmp_dir):
    for order in ("bs", "sb"):
        t = f"{tmp_dir}/{order}"
        _write(f"{t}-in/a.csv", ["A,1,1/2/2024", "NULL,2,1/2/2024", "A,1,1/2/2024"], "\n")
        for step in order:
            if step == "b":
                sinks.load_append(load_csv(spark, f"{t}-in", STRICT), t, dedup_keys=["name", "n"])
            else:
                stream_append(spark, f"{t}-in", STRICT, t, f"{t}-ck", dedup_keys=["name", "n"])
        assert rows(sinks.read_table(spark, t), "name", "n") == [("A", 1), (None, 2)]


def test_a_keyed_batch_that_runs_again_keeps_its_rows(spark, tmp_dir):
    a = spark.createDataFrame([(1,), (2,)], "k long")
    for _ in range(2):
        sinks.append(a, f"{tmp_dir}/t", ["k"], batch="s1")
    assert rows(sinks.read_table(spark, f"{tmp_dir}/t")) == [(1,), (2,)]


def test_ordered_export_in_part_order(spark, tmp_dir):
    n = 3000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("v")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # many parts of few rows
    try:
        sinks.export_csv(df, f"{tmp_dir}/x", order_by=["v", F.col("k").desc()])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(f for f in os.listdir(f"{tmp_dir}/x") if f.startswith("part-"))
    data = [open(f"{tmp_dir}/x/{f}", newline="").read() for f in parts]
    want = ["k,v", "-,-"] + [f"{r.k},{r.v or 'NULL'}" for r in sorted(df.collect(), key=lambda r: (r.v or "", -r.k))]
    assert len(parts) > 3 and data[0] == "k,v\r\n-,-\r\n"
    assert "".join(data) == "".join(line + "\r\n" for line in want)
    got = sorted(sinks.read_export(spark, f"{tmp_dir}/x").collect())
    assert [tuple(r) for r in got] == list(enumerate(want, 1))
    assert load_csv(spark, f"{tmp_dir}/x", LoadSpec(fields=("k", "v"), target=("k", "v"), header=("k", "v"))).rows.count() == n


def test_null_keys_and_repeats_in_a_batch(spark, tmp_dir):
    a = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "k long, v string")
    sinks.append(a, f"{tmp_dir}/t", ["k"], exists=False)
    sinks.append(a, f"{tmp_dir}/t", ["k"])
    assert rows(sinks.read_table(spark, f"{tmp_dir}/t")) == [(1, "b"), (None, "a")]


def test_charset_round_trip(spark, tmp_dir):
    from dataclasses import replace
    names = ["Jos\xe9", "O\u2019Brien \u201cJo\u201d \u20ac", " lead and trail ", 'in "quotes"']
    df = spark.createDataFrame([(n, "1", "1/2/2024") for n in names], "NAME string, N string, `EDIT DATE` string")
    for charset in ("windows-1252", "UTF-8"):
        sinks.export_csv(df, f"{tmp_dir}/{charset}", charset=charset)
        out = load_csv(spark, f"{tmp_dir}/{charset}", replace(STRICT, charset=charset)).rows
        assert rows(out, "name") == sorted((n,) for n in names)


def test_old_versions_and_temp_tables_are_removed(spark, tmp_dir):
    a = spark.createDataFrame([(1,)], "x long")
    old, new = sinks.refresh(a, f"{tmp_dir}/t"), sinks.refresh(a, f"{tmp_dir}/t")
    assert sinks.remove_old_versions(spark, f"{tmp_dir}/t", older_than_hours=1) == []
    assert sinks.remove_old_versions(spark, f"{tmp_dir}/t", older_than_hours=-1) == [f"version={old}"]
    assert sinks.current_version(spark, f"{tmp_dir}/t") == new and sinks.read_current(spark, f"{tmp_dir}/t").count() == 1
    materialize(a)
    assert remove_old_temp(spark, older_than_hours=100) == []


def test_no_shared_folder_is_an_error(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Bare:
        conf = Conf()
        sparkContext = type("C", (), {"getConf": staticmethod(Conf)})()

    try:
        ensure_checkpoint_dir(Bare())
    except ValueError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("no error")
