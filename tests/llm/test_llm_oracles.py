"""Queries over the documents table against SQL, row by row."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from deskwright.llm.oracles import ORACLES
from deskwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = sorted(repr([r[c] for c in columns]) for r in frame.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == sorted(repr([row[i] for i in order]) for row in cursor.fetchall())
