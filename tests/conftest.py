import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import local_session
    s = local_session("2", shuffle_partitions=4, app="panelkit-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a small test result as a list of tuples (ordered by all columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
