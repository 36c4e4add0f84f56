import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(app="strata-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(session)  # a temporary folder only if the session has none
    yield session


def order_key(t):
    """Sort key for tuples that may hold NULLs next to values."""
    return tuple((x is not None, x if isinstance(x, (int, float)) else str(x)) for x in t)


def rows(df, *cols):
    """Sorted plain tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=order_key)
