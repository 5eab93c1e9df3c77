import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from carestar.session import build_session
    # spark.checkpoint.dir comes from the environment when set; build_session
    # picks a fresh local folder only when it is unset
    s = build_session("local[4]", app="carestar-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from carestar.session import scratch_path
    return lambda name: scratch_path(spark, name)


def rows(df, *cols):
    """Sorted list of tuples (by all columns, NULL first)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is not None, x) for x in t))
