"""Every query of the folder with SQL gives the same rows as that SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import compare  # noqa: E402

from hirelake.llm import queries  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLES[name]) is None
