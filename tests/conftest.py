import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app_name="strata-tests")
    yield s
    s.stop()


def _key(t):
    return tuple((0, "") if v is None else (1, v) for v in t)


def srt(items):
    """Sort tuples that may hold NULLs (NULL first)."""
    return sorted(items, key=_key)


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return srt(tuple(r) for r in d.collect())
