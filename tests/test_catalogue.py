"""Named queries against DuckDB on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from deskwright.catalogue.oracles import ORACLES
from deskwright.catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Queries over whole runs take long to start; test_loading covers the same jobs.
RUNS = {
    "run_summary_batch", "rerun_idempotent", "dry_run_summary", "resume_after_failure",
    "resume_with_other_commit_size",
    "stream_ingest_resume", "stream_dedup_keys", "stream_quarantine", "stream_tickets",
    "tickets_of_a_stopped_run", "find_stored_tickets",
    "stored_tickets", "stored_quarantine", "total_tickets", "run_checkpoint", "run_lineage",
    "runs_listing", "metrics_listing", "report_markdown", "report_json",
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"input_fingerprint", "rows_fingerprint"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - RUNS))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = sorted(repr([plain(r[c]) for c in columns]) for r in frame.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    wanted = sorted(repr([plain(row[i]) for i in order]) for row in cursor.fetchall())
    assert sorted(names) == columns
    assert found == wanted


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_point(spark):
    row = entry.entry(spark).first()
    assert row["quality_score"] == 0.852647
