import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import get_session

    s = get_session(app="lakeops-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from lakeops.session import scratch_dir

    return scratch_dir(spark, "test")


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck_connect

    return duck_connect(SF_ORACLE)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

