"""Registered queries against their SQL, on whole tables, and what holds for all of them."""

import collections

import duckdb
import pytest

from callflow.llm import oracle, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.ALL))
def test_query_equals_sql(spark, duck, name):
    got = queries.ALL[name](spark, FOLDER)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = duck.execute(f"SELECT {columns} FROM ({oracle.ALL[name]})").fetchall()
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(want)


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.ALL) == list(range(1, 14))


EMPTY = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    for table, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.ALL[name](spark, str(tmp_path)).collect() == []
