import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare, tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def sql_engine():
    return tables(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, sql_engine, name):
    outcome = compare(name, spark, sql_engine, SMALL, oracle_sql().get(name))
    assert outcome.startswith(("ok", "rows")), outcome


def test_entry(spark):
    assert entry(spark).count() == 8


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
