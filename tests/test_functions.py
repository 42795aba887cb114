"""F1-F10 text rules and P17-P21 / D3-D10 date rules on inline rows."""

from pyspark.sql import functions as F

from conftest import d, ts
from visitmart.functions import text, timewin


def _one(spark, expr, schema, values):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_quote_name(spark):
    vals = ['O"Neil, Ann', "Smith, Jo", "a" * 128, "a" * 129, None]
    out = _one(spark, text.quote_name("v"), "v string", vals)
    assert out == ['"O""Neil, Ann"', '"Smith, Jo"', '"' + "a" * 128 + '"', '"' + "a" * 129 + '"', None]
    # the source function's rule, where it is asked for
    capped = _one(spark, text.quote_name("v", max_len=text.QUOTENAME_LIMIT), "v string", vals)
    assert capped == out[:3] + [None, None]


def test_concat_null_rules(spark):
    df = spark.createDataFrame([("Doe", None), ("Doe", "Jo")], "l string, f string")
    out = df.select(text.null_safe_concat(F.col("l"), "; ", F.col("f")).alias("a"),
                    F.concat(F.col("l"), F.lit(", "), F.col("f")).alias("b")).collect()
    assert [tuple(r) for r in out] == [("Doe; ", None), ("Doe; Jo", "Doe, Jo")]


def test_collation_compare(spark):
    vals = ["NP", "np  ", " np", None]
    assert _one(spark, text.eq_ci("v", "np"), "v string", vals) == [True, True, False, None]


def test_not_in_ci_leading_blank_and_null(spark):
    vals = ["Flush", " Flush", "MEMO ", "Other", None]
    out = _one(spark, text.not_in_ci("v", [" Flush", "memo"]), "v string", vals)
    # ' Flush' in the list does not exclude 'Flush'; NULL is dropped
    assert out == [True, False, False, True, None]


def test_contains_and_prefix(spark):
    vals = ["123 Homeless Shelter", "Main St", None]
    assert _one(spark, text.contains_ci("v", "homeless"), "v string", vals) == [True, False, None]
    assert _one(spark, text.startswith_ci("v", "main"), "v string", vals) == [False, True, None]


def test_non_blank(spark):
    vals = [None, "", " ", "D"]
    assert _one(spark, text.non_blank("v"), "v string", vals) == [False, False, False, True]


def test_name_lfm(spark):
    df = spark.createDataFrame([("doe", "jo", "q"), ("doe", "jo", None)], "l string, f string, m string")
    out = [r[0] for r in df.select(text.name_lfm("l", "f", "m")).collect()]
    assert out == ["DOE, JO Q", "DOE, JO"]


def test_day_window_inclusive(spark):
    now = ts(2024, 1, 10, 15, 0)
    vals = [ts(2024, 1, 9, 23, 59, 59), ts(2024, 1, 10, 0, 0), ts(2024, 1, 10, 14, 59, 59),
            ts(2024, 1, 24, 23, 59), ts(2024, 1, 25, 0, 0)]
    out = _one(spark, timewin.day_window_inclusive(F.col("v"), now, 14), "v timestamp_ntz", vals)
    assert out == [False, True, True, True, False]


def test_day_window_half_open(spark):
    now = ts(2024, 1, 10, 15, 0)
    vals = [ts(2024, 1, 10, 0, 0), ts(2024, 1, 23, 23, 59), ts(2024, 1, 24, 0, 0)]
    out = _one(spark, timewin.day_window_half_open(F.col("v"), now, 14), "v timestamp_ntz", vals)
    assert out == [True, True, False]


def test_rolling_windows_disjoint(spark):
    now = ts(2024, 1, 10, 18, 0)
    vals = [ts(2024, 1, 10, 18, 0), ts(2024, 1, 16, 18, 0), ts(2024, 1, 16, 18, 0, 1),
            ts(2024, 1, 17, 18, 0), ts(2024, 1, 17, 18, 0, 1)]
    six = _one(spark, timewin.rolling_window(F.col("v"), now, 0, 6), "v timestamp_ntz", vals)
    day7 = _one(spark, timewin.rolling_window(F.col("v"), now, 6, 7, lo_inclusive=False),
                "v timestamp_ntz", vals)
    assert six == [True, True, False, False, False]
    assert day7 == [False, False, True, True, False]
    assert not any(a and b for a, b in zip(six, day7))


def test_created_window(spark):
    now = ts(2024, 1, 10, 18, 0)
    vals = [ts(2024, 1, 9, 18, 0), ts(2024, 1, 10, 17, 59), ts(2024, 1, 10, 18, 0)]
    out = _one(spark, timewin.rolling_window(F.col("v"), now, -1, 0, hi_inclusive=False),
               "v timestamp_ntz", vals)
    assert out == [True, True, False]


def test_month_to_date_eomonth(spark):
    now = ts(2024, 2, 10, 9, 0)
    vals = [ts(2024, 2, 1, 0, 0), ts(2024, 2, 29, 0, 0), ts(2024, 2, 29, 10, 0), ts(2024, 1, 31, 23, 0)]
    assert _one(spark, timewin.month_to_date(F.col("v"), now), "v timestamp_ntz", vals) == \
        [True, True, False, False]
    assert _one(spark, timewin.month_to_date(F.col("v"), now, include_last_day=True),
                "v timestamp_ntz", vals) == [True, True, True, False]


def test_day_diff_and_formats(spark):
    df = spark.createDataFrame([(ts(2023, 12, 30, 23, 0), ts(2024, 1, 5, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(timewin.day_diff("a", "b").alias("n"), timewin.fmt_mdy("a").alias("m"),
                  timewin.fmt_ymd_compact("b").alias("c"), timewin.fmt_iso_day("b").alias("i")).first()
    assert (r.n, r.m, r.c, r.i) == (6, "12/30/2023", "20240105", "2024-01-05")


def test_age_years(spark):
    df = spark.createDataFrame([(d(2000, 2, 29), d(2001, 2, 28)), (d(2000, 2, 29), d(2001, 3, 1)),
                                (d(1980, 6, 15), d(2024, 6, 14)), (d(1980, 6, 15), d(2024, 6, 15))],
                               "b date, a date")
    assert [r[0] for r in df.select(timewin.age_years("b", "a")).collect()] == [0, 1, 43, 44]


def test_windows_do_not_depend_on_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Denver")
    try:
        now = ts(2024, 1, 10, 15, 0)
        vals = [ts(2024, 1, 9, 23, 59, 59), ts(2024, 1, 10, 0, 0), ts(2024, 1, 24, 23, 59), ts(2024, 1, 25, 0, 0)]
        out = _one(spark, timewin.day_window_inclusive(F.col("v"), now, 14), "v timestamp_ntz", vals)
        assert out == [False, True, True, False]
        got = spark.range(1).select(timewin.ts_literal(now).alias("t")).first().t
        assert got == now
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
