"""Every query against its SQL in another engine, on the same whole tables.

`LAMINA_SF_DIR` names another folder of tables than the small default.
"""

from __future__ import annotations

import os
import re
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry_points
from lamina.plans.report import plan_text
from lamina.workload.oracles import ORACLES
from lamina.workload.queries import QUERIES

FOLDER = os.environ.get("LAMINA_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')"
        )
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLES[name])

    ours = {field.name: SAME_TYPE[field.dataType.simpleString()] for field in df.schema}
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert ours == theirs

    check_plan(plan_text(df))
    order = sorted(ours)
    got = sorted(_keys([row[column] for column in order] for row in df.collect()))
    expected = sorted(_keys(relation.select(*order).fetchall()))
    assert len(got) == len(expected)
    assert got == expected
    assert got


def check_plan(text):
    """No product of two tables, no Python worker, and one task only for combined rows."""
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Window", "Scan ExistingRDD"):
        assert node not in text
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:], strict=False):
        if "SinglePartition" in line:
            assert re.search(r"HashAggregate\(keys=\[\], functions=\[partial_", below), below


def _keys(rows):
    """Rows in a form that sorts although values may be null."""
    return [tuple((value is not None, _plain(value)) for value in row) for row in rows]


def _plain(value):
    if isinstance(value, date | datetime):
        return value.isoformat()
    return 0 if value is None else value


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns == [
        "order_date",
        "category",
        "total_sales",
        "total_items_sold",
        "total_orders",
    ]
    assert df.count() > 0
