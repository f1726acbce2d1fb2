import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cantor.session import session

    shared = tmp_path_factory.mktemp("shared").as_uri()
    s = session("local[8]", 8, **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": shared})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
