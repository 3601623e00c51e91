import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripdemand.session import build_session, scratch_root
    s = build_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    scratch_root(s)  # tests: no checkpoint dir set, so a fresh local one is made
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    """A new scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="run-")


def lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")
