from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadsmith.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="leadsmith-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted tuples (optionally a column subset)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
