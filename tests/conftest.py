import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from histmart.session import build_session
    s = build_session("local[*]", app="histmart-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false",
                             # tests have no cluster-provided checkpoint folder: only here is one set
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="histmart-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="histmart-test-")
