import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from featherloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # interpreted execution: the test tables are far too small to repay compiling every plan
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
