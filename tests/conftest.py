import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from acctpulse.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    # tests run locally: a scratch checkpoint folder of our own
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="acctpulse-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_small(spark):
    from acctpulse.sources.fixtures import raw_tables

    return raw_tables(spark, SMALL)
