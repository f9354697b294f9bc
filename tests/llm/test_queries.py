"""The registered queries against their SQL, and what the entry point registers."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from lamina.llm.queries import LLM_ORACLES, LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, FOLDER)
    wanted = duck.sql(LLM_ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(wanted.columns)
    got = sorted(map(repr, (tuple(row[c] for c in order) for row in df.collect())))
    assert got == sorted(map(repr, wanted.select(*order).fetchall()))


def test_every_operator_is_registered_once():
    numbers = [name.split("_")[0] for name in LLM_QUERIES]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run
    assert set(LLM_ORACLES) <= set(entry_points.oracle_sql())
