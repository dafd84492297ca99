"""Every registered query against its SQL, over the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_its_sql(spark, con, key):
    df = queries()[key](spark, SF_DIR)
    if key in oracle_sql():
        assert difference(df, con, oracle_sql()[key]) == ""
    else:
        assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry_columns(spark):
    assert entry(spark).columns == [
        "request_id", "doc_id", "date", "guide_title", "chunk_no", "part_no", "n_parts", "kind", "prompt",
    ]
