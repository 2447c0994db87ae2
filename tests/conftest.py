import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import get_spark

    s = get_spark("sluice-tests", cpus=4, shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sluice-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sluice-test-")


def rows(df, *cols, order=None):
    """Collected rows as tuples, sorted for order-free comparison."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))
