"""F8, F9 in DISTINCT, GROUP BY and UNION (A8, A9, O6): spellings the collation holds equal are one row."""

from conftest import rows, ts
from pyspark.sql import functions as F
from test_schedule import _bump_inputs
from test_volumes import VIS, _inputs
from visitmart.functions.text import distinct_ci, group_ci
from visitmart.operators import cohort, schedule, volumes
from visitmart.params import VolumeSpec


def test_grouping_shows_the_least_row_and_keeps_null_and_blank_apart(spark):
    data = [("Ab ", "y", 1), ("ab", "X", 1), ("AB", "x ", 1), ("AB", "y", 1), (None, "x", 1), (None, "X", 1), ("", "x", 1), ("  ", "x", 1),
            (" ab", "x", 1), ("ab", "x", 2), ("\u00c9", None, 3), ("\u00e9 ", None, 3)]
    df = spark.createDataFrame(data, "`a.b` string, t string, n int")
    want = [("", "x", 1, 2), (" ab", "x", 1, 1), ("AB", "x ", 1, 2), ("AB", "y", 1, 2), ("ab", "x", 2, 1), (None, "X", 1, 2), ("\u00c9", None, 3, 2)]
    for n in (1, 5):
        got = group_ci(df.repartition(n), df.columns, F.count("*").alias("c"))
        assert got.columns == ["a.b", "t", "n", "c"] and got.schema["t"].dataType.simpleString() == "string"
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, distinct_ci(df).collect()), key=str) == sorted((w[:3] for w in want), key=str)
    assert sorted(map(tuple, distinct_ci(df.select("n")).collect())) == [(1,), (2,), (3,)]
    assert group_ci(df, ["n"], F.count("*").alias("c")).count() == 3 and distinct_ci(df.limit(0)).collect() == []


def test_bumps_take_one_earliest_edit_over_all_spellings(spark):
    sch, patient, ident, staff = _bump_inputs(spark)
    again = sch.filter("sch_id = 2" if "sch_id" in sch.columns else f"{sch.columns[0]} = 2")
    again = again.withColumn("activity", F.lit("CHEMO, iv  ")).withColumn("edit_dttm", F.lit(ts(2023, 12, 1)).cast("timestamp_ntz"))
    got = schedule.bumps(sch.unionByName(again), patient, ident, staff, "reschedule desk", ts(2024, 1, 10), literal_min=False)
    assert rows(got, "MRN", "ACTIVITY", "EDIT_DATE", "CALCULATED_DAYS") == [
        ("M 7", "CHEMO  iv  ", "12/01/2023", 50), ("M8", "Lab", "01/03/2024", 28)]


def test_union_holds_a_patient_once_per_spelling(spark):
    cols = ", ".join(f"{c} {'long' if c == 'pat_id1' else 'string'}" for c in cohort.COHORT_COLUMNS)
    first = spark.createDataFrame([("DOE, JO", 1, "2022-01-01", "20220105", "m1", "Y")], cols)
    second = spark.createDataFrame([("Doe, Jo ", 1, "2022-01-01", "20220105", "M1 ", "Y"), ("Doe, Jo", 2, "2022-01-01", "20220105", "m1", "Y")], cols)
    assert rows(cohort.cohort_union(first, second), "patient_name", "pat_id1", "pat_mrn") == [("DOE, JO", 1, "m1"), ("Doe, Jo", 2, "m1")]


def test_volumes_merge_spellings_of_a_visit(spark):
    visits, admin, vwp, prompt, race, _, _ = _inputs(spark)
    more = spark.createDataFrame([(3, "Poe, Ed", "m3 ", "20230301", "y", "JONES", "pat", "Breast ", "np", "new", "c", 2023)], VIS)
    out = volumes.specialty_volumes(visits.union(more), volumes.patient_profile(admin, vwp, race), prompt, VolumeSpec("breast", 2021, gender="keep"))
    assert rows(out, "MRN", "patient_name", "Provider") == [("M3", '"POE, ED"', "Jones; Pat")]
