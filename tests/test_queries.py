"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from qirtas.plans.oracles import ORACLES
from qirtas.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(small, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def test_names():
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert not any(n.startswith("op") or "pipeline" in n for n in QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    expected = _rows(columns, cursor.fetchall())
    assert expected, "an empty result checks nothing"
    assert _rows(df.columns, df.collect()) == expected


@pytest.mark.parametrize("name", ["lr_predictions", "svm_predictions", "rf_importance", "best_model"])
def test_model_queries_run(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


@pytest.mark.parametrize(
    "name, columns",
    [
        ("label_counts", "label:string"),
        ("source_counts", "source:string"),
        ("ttr_by_label", "text:string,label:string"),
        ("split_counts", "doc_id:bigint"),
        ("word_count_top", "text:string"),
    ],
)
def test_scans_read_only_what_they_need(spark, small, name, columns):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{columns}>" in plan


def test_top_k_is_not_a_full_sort(spark, small):
    plan = QUERIES["word_count_top"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def test_entry(spark):
    rows = {r["label"]: r["avg_ttr"] for r in contract.entry(spark).collect()}
    assert set(rows) == {"ai", "human"} and all(0 < v < 1 for v in rows.values())
