from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from editpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="editpulse-tests-")
    session = build_session(
        "editpulse-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=f"{work}/shared",
        spark__sql__warehouse__dir=f"{work}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def work_dir(tmp_path):
    return str(tmp_path)
