import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusgrams.session import build_session

    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cg-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cg-test-")
