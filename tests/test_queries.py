"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, rows_of
from reqsift.plans.oracle import ORACLE
from reqsift.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_rank_order(spark, con):
    rows = [tuple(r) for r in QUERIES["hosts_by_count"](spark, FOLDER).collect()]
    assert rows == con.execute(ORACLE["hosts_by_count"]).fetchall()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["host", "count"] and df.count() > 0


def test_no_planted_secret_in_the_results(spark):
    names = ["sift_archives", "unlisted_stream", "archives_to_archive", "added_to_finished_day", "archived_requests", "request_url", "redacted_requests", "framed_lines", "archive_rows", "payload_fields"]
    for name in names + ["form_params", "headers", "exposure_by_host"]:
        assert "PLANTED" not in repr(QUERIES[name](spark, FOLDER).collect()).upper(), name
