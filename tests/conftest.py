import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="sparkledger-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparisons."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
