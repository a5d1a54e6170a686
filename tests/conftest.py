import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="loglark-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
