"""Every query against its SQL twin, row by row, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import compare, oracle_connection  # noqa: E402
from orderloom.catalog import ORACLES, QUERIES  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    verdict = compare(spark, db, FOLDER, name)
    assert verdict.startswith("ok"), verdict
