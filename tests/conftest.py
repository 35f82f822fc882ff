import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewheel.scratch import release  # noqa: E402
from tidewheel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
