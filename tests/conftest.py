import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from encore.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="encore-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples (order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
