"""Every registered query against its SQL in an independent engine, at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(row[i], 9) + 0.0 if isinstance(row[i], float) else row[i] for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_equals_sql(spark, engine, name):
    df = entry_points.queries()[name](spark, FOLDER)
    if name not in entry_points.oracle_sql():
        assert df.count() >= 0
        return
    cursor = engine.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
