"""The training-data queries that SQL can express, row by row against it, on the smallest tables."""

import os

import pytest

pytest.importorskip("duckdb")

from check_oracle import compare, oracle_connection
from orderloom.llm.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, name):
    assert name in QUERIES
    verdict = compare(spark, db, FOLDER, name)
    assert verdict.startswith("ok"), verdict
