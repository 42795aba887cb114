"""The driver contract of __spark_entry__.py."""

import os

import pytest

import __spark_entry__ as entry
from visitmart.plans.catalog import QUERIES, SQL
from visitmart.plans.io_queries import IO_QUERIES, IO_SQL

LIBRARY = {**QUERIES, **IO_QUERIES}

SF = "/root/testdata/sf0.001"


def test_every_query_has_oracle_sql():
    assert set(LIBRARY) == {*SQL, *IO_SQL}
    assert set(LIBRARY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert all(isinstance(v, str) and v.strip() for v in entry.oracle_sql().values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry_schema_is_stable(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema
    assert len(a.columns) == len(set(c.lower() for c in a.columns))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_columns_are_unique_and_typed_for_hashing(spark):
    # Output columns are unique (case-insensitively) and carry no dates,
    # timestamps or floats, which hash differently across engines.
    for name, q in LIBRARY.items():
        df = q(spark, SF)
        assert len(df.columns) == len(set(c.lower() for c in df.columns)), name
        kinds = {f.dataType.simpleString() for f in df.schema.fields}
        assert kinds <= {"string", "bigint"}, (name, kinds)
