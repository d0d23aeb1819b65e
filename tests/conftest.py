import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from mercato.session import build_session

    s = build_session(os.environ.get("TEST_MASTER", "local[8]"), app_name="mercato-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001(spark):
    from mercato.sources.fixture import fixture_tables

    return fixture_tables(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf01(spark):
    from mercato.sources.fixture import fixture_tables

    return fixture_tables(spark, "/root/testdata/sf0.01")
