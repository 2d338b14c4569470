"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest
from conftest import SMALLEST

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_module  # noqa: E402
from checks.compare import compare, connect  # noqa: E402
from checks.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def connection():
    return connect(SMALLEST)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 15


def test_every_sql_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    same, text = compare(spark, connection, SMALLEST, name)
    assert same, text
