"""Every registered query against its SQL in DuckDB, and against itself on other layouts."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as registry  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(registry.queries()[name](spark, FOLDER), duck, registry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert registry.entry(spark).count() > 0
