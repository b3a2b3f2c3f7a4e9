"""Registered queries with SQL, on the smallest given tables: a few of every kind, all with TEST_QUERIES=1 (many minutes)."""

import os

import pytest
from tests.oracle import connect, difference

from workload import cleaning, extraction, inference, loading, messages  # noqa: F401
from workload.base import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUICK = ["assign_ids", "clean_value", "ensure_table", "infer_schema_by_page", "ingest_bad_values", "quarantine_bad_rows", "typed_load"]
NAMES = sorted(ORACLES) if os.environ.get("TEST_QUERIES") else QUICK


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no tables in {SF_DIR}")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
