from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=warehouse,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *columns):
    """Rows as sorted tuples (nulls first)."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: tuple((x is not None, x) for x in r))
