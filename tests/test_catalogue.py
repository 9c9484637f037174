"""Every query with a SQL counterpart against DuckDB, over the whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import DATA, plan_text
from webfacts.plans import oracle, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, SQL = {q.__name__: q for q in queries.CATALOGUE}, oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def as_text(rows):
    return sorted(tuple("~" if v is None else repr(float(v)) if isinstance(v, float) else str(v)
                        for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    rows = want.fetchall()
    order = [want.columns.index(c) for c in columns]
    assert as_text(got.select(*columns).collect()) == as_text([[r[i] for i in order] for r in rows])
    assert rows
    plan = plan_text(got)
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_every_counterpart_has_a_query():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL.items()) <= set(entry_points.oracle_sql().items())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"svm_predictions", "svm_grid", "page_facts"}


def test_flagship(spark):
    lines = entry_points.entry(spark)
    assert lines.columns == ["value"]
    rows = [r["value"] for r in lines.collect()]
    assert len(rows) % 3 == 0
    assert all(r.startswith(("ENTITY: page-", "RELATION: page-")) for r in rows)


def test_predictions_are_of_the_known_classes(spark):
    rows = QUERIES["svm_predictions"](spark, DATA).collect()
    assert {r["preds"] for r in rows} <= {r["label"] for r in rows} | {
        "Other nan", "Cause-Effect e1,e2", "Cause-Effect e2,e1"}
