import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ludoscope.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return SF
