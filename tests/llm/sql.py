"""Compares a query with its SQL on DuckDB."""

import os

import duckdb

from tests.test_queries import TABLES, _rows


def assert_same(df, sql, folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = _rows(columns, cursor.fetchall())
    con.close()
    assert sorted(df.columns) == sorted(columns)
    assert expected, "an empty result checks nothing"
    assert _rows(df.columns, df.collect()) == expected
