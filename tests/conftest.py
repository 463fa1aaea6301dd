"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.plans.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    ship(session)
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    if not Path(DATA).exists():
        pytest.skip("no test data")
    return DATA
