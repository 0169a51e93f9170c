from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexmill.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    found = session(
        "local[4]",
        shuffle_partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def text_file(tmp_path):
    """Write lines to a fresh file and return its path."""

    def write(name: str, *lines: str, end: str = "\n") -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(end.join(lines).encode())
        return str(path)

    return write
