"""Property tests: Spark expressions against plain-Python models of the
source's semantics, on generated batches (one Spark job per batch)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from visitmart.functions import text
from visitmart.sources.csvload import parse_mysql_date

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def quotename_model(s):
    if s is None:
        return None
    return '"' + s.replace('"', '""') + '"'


def fold_model(s):
    return None if s is None else s.rstrip(" ").lower()


texts = st.one_of(st.none(), st.text(alphabet=st.sampled_from('ab"C, \té'), max_size=140))


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40))
def test_quote_name_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(text.quote_name("v")).collect()]
    assert got == [quotename_model(v) for v in values]


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40), st.sampled_from(["ab", "C ", " a", "é"]))
def test_collation_equality_model(spark, values, lit):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(text.eq_ci("v", lit)).collect()]
    assert got == [None if v is None else fold_model(v) == fold_model(lit) for v in values]


days = st.dates(min_value=dt.date(1901, 1, 1), max_value=dt.date(2099, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(days, st.booleans(), st.sampled_from(["", " 10:30", "x"])), min_size=1, max_size=30))
def test_mdy_dates_model(spark, items):
    # MySQL reads '%m/%d/%Y' with or without zero padding and ignores trailing text.
    raw = [(f"{d.month:02d}/{d.day:02d}/{d.year}" if pad else f"{d.month}/{d.day}/{d.year}") + tail
           for d, pad, tail in items]
    df = spark.createDataFrame([(r,) for r in raw], "v string")
    got = [r[0] for r in df.select(parse_mysql_date("v", "%m/%d/%Y")).collect()]
    assert got == [d for d, _, _ in items]


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2060, 1, 1)),
                min_size=1, max_size=30))
def test_iso_datetimes_model(spark, values):
    raw = [v.strftime("%Y-%m-%d %H:%M:%S") + ".000" for v in values]   # style 121 tail ignored
    df = spark.createDataFrame([(r,) for r in raw], "v string")
    got = [r[0] for r in df.select(parse_mysql_date("v", "%Y-%m-%d %H:%i:%s")).collect()]
    assert got == [v.replace(microsecond=0) for v in values]


@SETTINGS
@given(st.lists(st.one_of(days, st.just(None)), min_size=1, max_size=30))
def test_compact_dates_model(spark, values):
    raw = [None if d is None else d.strftime("%Y%m%d") for d in values]
    df = spark.createDataFrame([(r,) for r in raw], "v string")
    got = [r[0] for r in df.select(parse_mysql_date("v", "%Y%m%d")).collect()]
    assert got == values
