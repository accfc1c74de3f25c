"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as registered
from check_oracle import compare


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_every_query_has_sql():
    """Those of the training-data operators need not have any."""
    own = set(registered.queries()) - set(registered.LLM_QUERIES)
    assert own <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name)
