"""Every registered query against its SQL, on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from tidegate.plans.oracle import ORACLE
from tidegate.plans.queries import QUERIES
from tools.check_oracle import canonical

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF_DIR).toArrow().to_pandas(integer_object_nulls=True)
    want = db.sql(entry.oracle_sql()[name]).to_arrow_table().to_pandas(integer_object_nulls=True)
    assert canonical(got) == canonical(want)
