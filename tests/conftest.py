import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from metframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, 4)
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return lambda name: str(tmp_path / name)
