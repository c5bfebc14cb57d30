import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourglass.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", master="local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect to a list of tuples ordered by the given columns."""
    return [tuple(r) for r in df.orderBy(*cols).collect()]
