from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from waymark.session import local_session

    session = local_session(4, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
