"""Every registered query equals its SQL in DuckDB: columns, types, rows and values."""

import collections
import glob
import os

import duckdb
import pytest

from callflow.plans import oracle, queries as catalogue

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.ALL, oracle.ALL
KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def check(spark, duck, name, folder):
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert types == {c: KINDS[t] for c, t in got.dtypes}
    picked = ", ".join(f'"{c}"' for c in columns)
    want = duck.execute(f"SELECT {picked} FROM ({SQL[name]}) AS wanted").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert collections.Counter(rows) == collections.Counter(want)
    return rows


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert check(spark, duck, name, FOLDER)


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_results_do_not_depend_on_session_settings(spark, small, name):
    other = {
        "spark.sql.timestampType": "TIMESTAMP_LTZ",
        "spark.sql.session.timeZone": "Asia/Kolkata",
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "20000",
    }
    before = {key: spark.conf.get(key) for key in other}
    for key, value in other.items():
        spark.conf.set(key, value)
    try:
        check(spark, small, name, SMALL)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
