import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from recomart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield s
    s.stop()
