"""Every registered query with SQL gives the same rows as that SQL."""

import os

import compare
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows_of_its_schema(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)
    assert len(set(df.columns)) == len(df.columns) and any(x is not None for x in rows[0])


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"skill", "Entry", "Mid", "Senior", "highest"}
