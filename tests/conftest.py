import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from parley.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]", 8,
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="parley-tests-"), "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.buffer.pageSize": "2m"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
