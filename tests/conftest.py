import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyfold.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tallyfold-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyfold-tests-"),
                             "spark.cleaner.referenceTracking.cleanCheckpoints": "true"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the selected columns (None sorts first)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
