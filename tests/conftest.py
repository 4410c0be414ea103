import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlytics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app="eventlytics-tests",
                      extra={"spark.driver.memory": "4g"})
    # tests only: no shared checkpoint folder is configured, so use a local one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlytics-test-ckpt-"))
    yield s


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted tuples of the chosen columns (results compare as multisets)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
