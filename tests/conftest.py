import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from formtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, app="formtide-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
