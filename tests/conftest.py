import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as sorted tuples, nulls first."""

    def collect(df, *cols):
        out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(out, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])

    return collect
