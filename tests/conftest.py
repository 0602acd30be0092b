import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from fleetgauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, "tests", spark__checkpoint__dir=tempfile.mkdtemp(prefix="fleetgauge-tests-"), spark__sql__shuffle__partitions="4"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
