from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from auric.session import build_session
    s = build_session("local[4]", app="auric-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="auric-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def work(spark):
    from auric.session import workspace
    return lambda name="t": workspace(spark, name)
