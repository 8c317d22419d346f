import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfrank.session import get_session

    s = get_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a sorted list of tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
