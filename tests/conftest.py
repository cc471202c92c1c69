from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from statewatt.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *cols):
        found = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(found, key=lambda t: tuple((v is not None, str(type(v)), v) for v in t))

    return collect
