"""Registered queries against DuckDB on the smallest tables.

A selection by default; ``CAIRN_ALL=1`` runs every query.
"""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cairn_queries import all_queries
from tools.check import TABLES, duck_type, rows

FOLDER = "/root/testdata/sf0.001"
SELECTION = (
    "stg_legacyres__reservations", "stg_vistareserve__reservations", "stg_granttrack__award_budget_by_fiscal_year",
    "int_parks", "int_ecological_surveys", "fct_park_occupancy_daily_snapshot", "fct_visitation", "rpt_park_revenue_summary",
    "golden_record", "join_full_outer_three_way", "join_left_salted", "check_revenue_balance", "quality_summary",
    "quick_profile", "candidate_keys_composite", "redact_columns", "synonym_match", "lineage_staging_off_source",
    "export_csv_and_parquet")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.oracle_sql()) if os.environ.get("CAIRN_ALL") else SELECTION)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    expected = duck.execute(entry.oracle_sql()[name])
    types = {d[0]: duck_type(d[1]) for d in expected.description}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    want = rows(expected.fetchall(), list(types))
    assert rows([tuple(r) for r in df.collect()], df.columns) == want


def test_every_query_has_sql():
    assert {name for name, q in all_queries().items() if not q.sql} == set()


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_are_listed_without_a_session():
    listed = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", listed], cwd=Path(__file__).resolve().parents[1], check=True, timeout=120)
