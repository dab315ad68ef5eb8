"""Every registered query runs; those with SQL give the same rows as it does."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from oracle_check import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", list(entry_point.queries()))
def test_query(spark, con, key):
    said = compare(spark, con, FOLDER, key)
    assert said.startswith(("ok", "rows")), said
    assert said.split()[1] != "0", said


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["date", "fuel_type", "total_generation_mwh", "generation_percentage"]
    assert df.limit(1).count() == 1


def test_registry():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
