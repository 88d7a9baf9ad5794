import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from aeris.session import build_session

    scratch = tempfile.mkdtemp(prefix="aeris-tests-")
    os.environ.setdefault("AERIS_SCRATCH", scratch)
    session = build_session(master="local[4]", shuffle_partitions=4, app_name="aeris-tests",
                            driver_memory="4g")
    yield session
    session.stop()


def rows(df, *cols):
    """Collect a small test result as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is not None, str(v)) for v in t))
