"""Every registered query against its oracle on the smallest tables."""

from pathlib import Path

import pytest
from compare import mismatch, oracle_connection

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, connection, name):
    problem = mismatch(spark, connection, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert problem is None, problem


def test_json_edges_of_all_events(spark):
    folder = "/root/testdata/sf0.1"
    name, events = "json_edge_events", spark.read.parquet(f"{folder}/events.parquet")
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert events.where("user_id >= 256").count() > 0 and query(spark, folder).count() == events.count()
    problem = mismatch(spark, oracle_connection(folder), name, query, sql, folder)
    assert problem is None, problem
