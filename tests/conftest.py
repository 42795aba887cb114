import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(tempfile.mkdtemp(prefix="visitmart-ckpt-"), "local[4]", shuffle_partitions=4, app_name="visitmart-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="visitmart-test-")


def ts(*a):
    return dt.datetime(*a)


def d(*a):
    return dt.date(*a)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
